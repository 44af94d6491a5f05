"""Permutation importance: how much a metric falls when one feature is taken
from another row.

The other row is the next one in a seeded hash order, inside hash buckets of a
bounded size (the last row of a bucket takes the first one's values).  That is a
permutation of the rows, decided by keys alone: the same for every layout and
retry, without a global sort or row numbers, and any engine with md5 gives it.
All features are tried in one pass: each row is repeated once per feature and
predicted with that feature replaced, so the prediction may be any expression
over the feature columns, a compiled model included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from userflow.functions.columns import e, hash_unit_sql
from userflow.operators.evaluate import metrics

ROWS_PER_BUCKET = 10_000


def with_donors(df: DataFrame, columns: list[str], key: str, seed: int, buckets: int) -> DataFrame:
    """``df`` with struct ``_donor``: ``columns`` of the next row of its bucket."""
    order = hash_unit_sql(f"`{key}`", seed)
    w = Window.partitionBy("_split").orderBy("_order", key)
    own = F.struct(*columns)
    return (df.withColumn("_order", e(order)).withColumn("_split", e(f"pmod(_order, {int(buckets)})"))
            .withColumn("_donor", F.coalesce(F.lead(own).over(w), F.first(own).over(w)))
            .drop("_order", "_split"))


def permutation_importance(df: DataFrame, label: str, prediction_sql: str, features: list[str], key: str, seed: int,
                           buckets: int | None = None) -> DataFrame:
    """(feature, baseline_accuracy, permuted_accuracy, importance, rank): by how
    much the accuracy of ``prediction_sql`` falls when a feature is permuted;
    features of equal importance are ranked by name.

    The prediction may use other columns of ``df`` too.  ``key`` names rows apart (rows of one key fall into one bucket); ``buckets``
    defaults to one per :data:`ROWS_PER_BUCKET` rows.  Rows whose label or
    prediction is neither 0 nor 1 count nowhere; without rows that count, the
    accuracies are null.  An empty table gives one row per feature.
    """
    if buckets is None:
        buckets = max(1, -(-df.count() // ROWS_PER_BUCKET))
    tried = with_donors(df, features, key, seed, buckets).select("*", e(f"explode(sequence(-1, {len(features) - 1}))", "_v"))
    replaced = tried.withColumns({f: e(f"if(_v = {i}, _donor.`{f}`, `{f}`)") for i, f in enumerate(features)})
    found = metrics(replaced.select(label, "_v", e(prediction_sql, "prediction")), label, by=["_v"])
    spark = df.sparkSession
    names = spark.range(-1, len(features)).select(
        F.col("id").cast("int").alias("_v"),
        e(f"element_at(array('', {', '.join(repr(f) for f in features)}), cast(id as int) + 2)", "feature"))
    each = names.join(found.select("_v", "accuracy"), "_v", "left")
    # As many rows as features: ranked in one sorted array.
    rows_ = each.agg(F.collect_list(F.struct("_v", "feature", "accuracy")).alias("_r")).select(
        "_r", e("element_at(filter(_r, x -> x._v = -1), 1).accuracy", "baseline_accuracy"))
    ranked = rows_.select("baseline_accuracy", e(
        "posexplode(array_sort(transform(filter(_r, x -> x._v >= 0), x -> struct("
        "-round(baseline_accuracy - x.accuracy, 9) as fall, x.feature as feature, x.accuracy as accuracy))))").alias("_pos", "_x"))
    return ranked.select(
        F.col("_x.feature").alias("feature"), "baseline_accuracy", F.col("_x.accuracy").alias("permuted_accuracy"),
        (F.col("baseline_accuracy") - F.col("_x.accuracy")).alias("importance"), (F.col("_pos") + 1).alias("rank"))
