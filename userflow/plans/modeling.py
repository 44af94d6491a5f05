"""Model pipelines: assemble -> scale -> classify, importances, persistence,
parameter sweeps and side-by-side evaluation."""

from __future__ import annotations

import time
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from userflow.operators.evaluate import metrics, tag_sets
from userflow.operators.features import FEATURES
from userflow.session import materialize, shared_path

RAW = "unscaled_features"
SCALED = "features"
KINDS = ("gbt", "rf", "lr", "dt", "nb")

# Settings of the fitted lifecycle models: 50 boosting rounds of depth-10 trees.
GBT_ROUNDS = 50
GBT_DEPTH = 10


def make_classifier(kind: str, label: str, **params):
    """Classifier by short name.  Naive Bayes reads the unscaled features,
    since centring makes values negative and it accepts none."""
    if kind == "gbt":
        params.setdefault("maxIter", GBT_ROUNDS)
        params.setdefault("maxDepth", GBT_DEPTH)
        return GBTClassifier(labelCol=label, featuresCol=SCALED, **params)
    if kind == "rf":
        return RandomForestClassifier(labelCol=label, featuresCol=SCALED, **params)
    if kind == "lr":
        return LogisticRegression(labelCol=label, featuresCol=SCALED, **params)
    if kind == "dt":
        return DecisionTreeClassifier(labelCol=label, featuresCol=SCALED, **params)
    if kind == "nb":
        return NaiveBayes(labelCol=label, featuresCol=RAW, **params)
    raise ValueError(f"unknown classifier {kind!r}; one of {KINDS}")


def build_pipeline(label: str, kind: str = "gbt", features: list[str] | None = None, **params) -> Pipeline:
    """Assembler (fails on nulls) -> centring and scaling -> classifier."""
    assembler = VectorAssembler(inputCols=list(features or FEATURES), outputCol=RAW, handleInvalid="error")
    scaler = StandardScaler(inputCol=RAW, outputCol=SCALED, withMean=True, withStd=True)
    return Pipeline(stages=[assembler, scaler, make_classifier(kind, label, **params)])


def scaled_features(df: DataFrame, keep: list[str], features: list[str] | None = None) -> DataFrame:
    """Fit assembler + scaler on ``df`` and return ``keep`` plus one scaled column per feature."""
    from pyspark.ml.functions import vector_to_array

    feats = list(features or FEATURES)
    stages = build_pipeline("unused", "gbt", feats).getStages()[:2]
    model = Pipeline(stages=stages).fit(df)
    arr = vector_to_array(F.col(SCALED))
    return model.transform(df).select(*keep, *[arr[i].alias(f) for i, f in enumerate(feats)])


def importances(spark: SparkSession, model: PipelineModel, features: list[str] | None = None) -> DataFrame:
    """(feature, importance, importance_pct, rank) of the final tree stage,
    percent cut to two decimals, most important first."""
    names = list(features or FEATURES)
    values = model.stages[-1].featureImportances.toArray().tolist()
    schema = T.StructType([T.StructField("feature", T.StringType()), T.StructField("importance", T.DoubleType())])
    df = spark.createDataFrame(list(zip(names, [float(v) for v in values], strict=True)), schema)
    pct = F.floor(F.col("importance") * F.lit(10000.0)) / F.lit(100.0)
    return df.select(
        "feature", "importance", pct.alias("importance_pct"),
        F.row_number().over(_rank_window()).alias("rank"),
    )


def _rank_window():
    from pyspark.sql import Window

    return Window.orderBy(F.desc("importance"), F.asc("feature"))


def save_model(spark: SparkSession, model: PipelineModel, path: str | None = None) -> str:
    """Write a fitted pipeline (default: a new folder under the shared checkpoint folder)."""
    path = path or shared_path(spark, "models")
    model.write().overwrite().save(path)
    return path


def score(model_path: str, features: DataFrame) -> DataFrame:
    """Batch-score a feature table with a saved pipeline."""
    return PipelineModel.load(model_path).transform(features)


def scoring_model(feature_stage, fitted: PipelineModel) -> PipelineModel:
    """Event log -> features -> prediction as one persistable model.

    The feature stage (a :class:`WindowedFeatures`) is stored first, so the
    window settings used in training travel with the model.
    """
    return PipelineModel(stages=[feature_stage, *fitted.stages])


def score_log(model_path: str, log: DataFrame, cutoff_ms: int | None = None) -> DataFrame:
    """Load a scoring model and apply it to a raw event log, optionally at a
    new first cutoff."""
    model = PipelineModel.load(model_path)
    if cutoff_ms is not None:
        model.stages[0].setCutoffMs(int(cutoff_ms))
    return model.transform(log)


def evaluate_sets(model: PipelineModel, sets: dict[str, DataFrame], label: str) -> DataFrame:
    """Metrics of one model on several named sets, one row per set."""
    return metrics(model.transform(tag_sets(sets)), label, by=["dataset"])


#: What (rounds, depth) of a sweep means for each classifier.
SWEEP_PARAMS = {
    "gbt": lambda rounds, depth: {"maxIter": rounds, "maxDepth": depth},
    "rf": lambda rounds, depth: {"numTrees": rounds, "maxDepth": depth},
    "lr": lambda rounds, depth: {"maxIter": rounds},
    "dt": lambda rounds, depth: {"maxDepth": depth},
    "nb": lambda rounds, depth: {},
}


@dataclass
class GridPoint:
    rounds: int
    depth: int
    model: PipelineModel
    fit_seconds: float


def prepare(train: DataFrame, label: str, kind: str, features: list[str] | None = None) -> tuple[PipelineModel, DataFrame, object]:
    """Assembler and scaler fitted once, the training rows they give (label and
    the one vector the classifier reads, written once), and the classifier."""
    *before, classifier = build_pipeline(label, kind, features).getStages()
    fitted = Pipeline(stages=before).fit(train)
    ready = materialize(fitted.transform(train).select(label, classifier.getFeaturesCol()))
    return fitted, ready, classifier


def fit_grid(train: DataFrame, label: str, grid: list[tuple[int, int]], kind: str = "gbt", parallelism: int = 2,
             features: list[str] | None = None) -> list[GridPoint]:
    """One fitted pipeline per (rounds, depth), in the grid's order.

    Features are assembled and scaled in one pass over ``train`` and shared by all
    points; ``parallelism`` fits run at a time, so jobs of one point fill the
    executors that another leaves idle."""
    fitted, ready, classifier = prepare(train, label, kind, features)
    maps = [{classifier.getParam(k): v for k, v in SWEEP_PARAMS[kind](*point).items()} for point in grid]
    fits = classifier.fitMultiple(ready, maps)

    def one(_):
        start = time.time()
        index, model = next(fits)
        return index, model, time.time() - start

    out: list[GridPoint | None] = [None] * len(grid)
    with ThreadPool(max(1, min(parallelism, len(grid)))) as pool:
        run = inheritable_thread_target(train.sparkSession)(one)
        for index, model, seconds in pool.imap_unordered(run, range(len(grid))):
            out[index] = GridPoint(*grid[index], PipelineModel(stages=[*fitted.stages, model]), seconds)
    return out


def evaluate_grid(points: list[GridPoint], sets: dict[str, DataFrame], label: str) -> DataFrame:
    """Metrics of every point on every set, in one pass over the sets: the rows
    are assembled and scaled once, each model adds its prediction to them."""
    *before, classifier = points[0].model.stages
    rows = PipelineModel(stages=before).transform(tag_sets(sets)).select("dataset", label, classifier.getFeaturesCol())
    for i, p in enumerate(points):
        model = p.model.stages[-1].copy().setPredictionCol(f"_p{i}")
        for clear in ("setRawPredictionCol", "setProbabilityCol"):
            if hasattr(model, clear):
                getattr(model, clear)("")
        rows = model.transform(rows)
    each = F.array(*[F.struct(
        F.lit(i).alias("point"), F.lit(p.rounds).alias("rounds"), F.lit(p.depth).alias("depth"),
        F.lit(round(p.fit_seconds, 3)).alias("fit_seconds"), F.col(f"_p{i}").alias("prediction")) for i, p in enumerate(points)])
    stacked = rows.select("dataset", label, F.explode(each).alias("_e")).select("dataset", label, "_e.*")
    by = ["point", "rounds", "depth", "fit_seconds", "dataset"]
    return metrics(stacked, label, by=by).drop("point")


def sweep(train: DataFrame, sets: dict[str, DataFrame], label: str, grid: list[tuple[int, int]],
          kind: str = "gbt", parallelism: int = 2) -> DataFrame:
    """Fit one pipeline per (rounds, depth) and report metrics on every set,
    with the fit time in seconds.  A classifier uses what it has of the two
    (:data:`SWEEP_PARAMS`); points that come to the same parameters are all fitted."""
    return evaluate_grid(fit_grid(train, label, grid, kind, parallelism), sets, label)
