"""Confusion counts and ratios as aggregates (nothing brought to the driver)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from userflow.functions.columns import safe_ratio

METRIC_COLUMNS = ["tp", "tn", "fp", "fn", "total", "recall", "precision", "accuracy", "f1"]


def metrics(pred: DataFrame, label: str, prediction: str = "prediction", by: list[str] | None = None) -> DataFrame:
    """tp, tn, fp, fn, total, recall, precision, accuracy and F1 per ``by`` group.

    A ratio whose divisor is 0 is NULL (recall without positives, precision
    without predicted positives, F1 when either is NULL or both are 0).
    Rows whose label or prediction is neither 0 nor 1 count in no cell.
    """
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    counts = pred.groupBy(*(by or [])).agg(
        F.count_if((y == 1.0) & (p == 1.0)).alias("tp"),
        F.count_if((y == 0.0) & (p == 0.0)).alias("tn"),
        F.count_if((y == 0.0) & (p == 1.0)).alias("fp"),
        F.count_if((y == 1.0) & (p == 0.0)).alias("fn"),
    )
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    total = tp + tn + fp + fn
    r = safe_ratio(tp, tp + fn)
    pr = safe_ratio(tp, tp + fp)
    return counts.select(
        *(by or []),
        "tp", "tn", "fp", "fn",
        total.alias("total"),
        r.alias("recall"),
        pr.alias("precision"),
        safe_ratio(tp + tn, total).alias("accuracy"),
        (F.lit(2.0) * r * pr / F.nullif(pr + r, F.lit(0.0))).alias("f1"),
    )


def tag_sets(sets: dict[str, DataFrame], column: str = "dataset") -> DataFrame:
    """Union of named sets with a ``dataset`` column, for side-by-side metrics."""
    out = None
    for name, df in sets.items():
        t = df.withColumn(column, F.lit(name))
        out = t if out is None else out.unionByName(t)
    return out
