"""Fitted classifiers as Column expressions over the plain feature columns.

A fitted pipeline (assembler, scaler, classifier) is compiled into SQL text:
nested CASE per tree and a weighted sum for tree ensembles, a linear form for
logistic regression, one linear form per class for naive Bayes.  Scoring is then
an ordinary projection: no ML vectors, no Python, and filters on the prediction
or unused features are the optimizer's business.

Scaling is folded into the trees: scaling keeps the order of values, so each
threshold becomes the largest raw value that still goes left, found by bisection
over doubles with the scaler's own arithmetic.  Decisions are therefore equal
bit for bit, not up to rounding.

A row with a null feature has a null prediction (the assembler stops there).
"""

from __future__ import annotations

import struct
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    GBTClassificationModel,
    LogisticRegressionModel,
    NaiveBayesModel,
    RandomForestClassificationModel,
)
from pyspark.ml.feature import StandardScalerModel, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from userflow.functions.columns import e
from userflow.session import shared_path

#: Nodes of an ensemble up to which its expression becomes generated code.  Beyond,
#: one method of it would pass the JVM's 64 KB; see :func:`_evaluated`.
COMPILED_NODES = 200

_TREES = (DecisionTreeClassificationModel, RandomForestClassificationModel, GBTClassificationModel)


# --- tree nodes ---------------------------------------------------------------

def tree_nodes(spark: SparkSession, model, path: str | None = None) -> dict[int, dict[int, dict]]:
    """{tree: {node: fields}} of a fitted tree model, read from the node table
    Spark ML stores with it (written below the shared folder unless ``path`` is
    an already saved model).  A model's nodes are bounded by rounds and depth,
    not by data."""
    if path is None:
        path = shared_path(spark, "models")
        model.write().save(path)
    rows = spark.read.parquet(f"{path}/data")
    if "nodeData" in rows.columns:
        rows = rows.select("treeID", "nodeData.*")
    else:  # a single tree
        rows = rows.withColumn("treeID", F.lit(0))
    out: dict[int, dict[int, dict]] = {}
    for r in rows.collect():
        out.setdefault(r["treeID"], {})[r["id"]] = r.asDict(recursive=True)
    return out


def _double(x: float) -> str:
    return f"{float(x)!r}D" if x == x and abs(x) != float("inf") else f"double('{x}')"


def _key(x: float) -> int:
    """Doubles as integers of the same order."""
    bits = struct.unpack("<q", struct.pack("<d", x))[0]
    return bits if bits >= 0 else -(bits & 0x7FFF_FFFF_FFFF_FFFF)


def _from_key(k: int) -> float:
    return struct.unpack("<d", struct.pack("<q", k))[0] if k >= 0 else -struct.unpack("<d", struct.pack("<q", -k))[0]


def raw_threshold(scaled: Callable[[float], float], threshold: float) -> float | None:
    """The largest finite double whose scaled value is at most ``threshold``
    (None: none is)."""
    top = 1.7976931348623157e308
    lo, hi = _key(-top), _key(top)
    if scaled(-top) > threshold:
        return None
    if scaled(top) <= threshold:
        return top
    while hi - lo > 1:  # scaled(lo) <= threshold < scaled(hi)
        mid = (lo + hi) // 2
        if scaled(_from_key(mid)) <= threshold:
            lo = mid
        else:
            hi = mid
    return _from_key(lo)


def _scaling(model: PipelineModel, n: int) -> list[Callable[[float], float]]:
    """What the pipeline's scaler does to each feature (nothing without one)."""
    scaler = next((s for s in model.stages if isinstance(s, StandardScalerModel)), None)
    if scaler is None:
        return [lambda x: x] * n
    shift = scaler.mean.toArray().tolist() if scaler.getWithMean() else [0.0] * n
    scale = [1.0 / s if s else 0.0 for s in scaler.std.toArray().tolist()] if scaler.getWithStd() else [1.0] * n
    return [lambda x, m=m, s=s: (x - m) * s for m, s in zip(shift, scale, strict=True)]


def _tree_sql(nodes: dict[int, dict], features: list[str], scaled: list, leaf: Callable[[dict], str], at: int = 0) -> str:
    node = nodes[at]
    if node["leftChild"] < 0:
        return leaf(node)
    split = node["split"]
    if split["numCategories"] >= 0:
        raise ValueError("categorical splits have no feature column here")
    f = split["featureIndex"]
    limit = raw_threshold(scaled[f], split["leftCategoriesOrThreshold"][0])
    left, right = (_tree_sql(nodes, features, scaled, leaf, node[c]) for c in ("leftChild", "rightChild"))
    if limit is None:
        return right
    return f"CASE WHEN `{features[f]}` <= {_double(limit)} THEN {left} ELSE {right} END"


def _evaluated(sql: str, trees: dict[int, dict[int, dict]]) -> str:
    """``sql`` of some trees, inside a lambda if they are many nodes: Spark walks a
    lambda's expression tree as it is and generates no code for it, so a large
    ensemble costs one node visit per level and tree, whatever its size."""
    if sum(map(len, trees.values())) <= COMPILED_NODES:
        return sql
    return f"element_at(transform(array(0), _ -> {sql}), 1)"


def _sum(terms: list[str]) -> str:
    return "(" + " + ".join(terms) + ")"


def _class_share(k: int) -> Callable[[dict], str]:
    def leaf(node: dict) -> str:
        stats = node["impurityStats"]
        total = sum(stats)
        return _double(stats[k] / total if total else 0.0)

    return leaf


def margin_sql(spark: SparkSession, model: PipelineModel) -> str:
    """SQL text of a value above 0 for class 1, else class 0 (two classes)."""
    features = _features(model)
    last = model.stages[-1]
    reads_raw = isinstance(last, NaiveBayesModel)
    scaled = [lambda x: x] * len(features) if reads_raw else _scaling(model, len(features))
    if isinstance(last, GBTClassificationModel):
        trees = tree_nodes(spark, last)
        return _evaluated(_sum([
            f"{_double(w)} * {_tree_sql(trees[i], features, scaled, lambda n: _double(n['prediction']))}"
            for i, w in enumerate(last.treeWeights)]), trees)
    if isinstance(last, _TREES):
        if last.numClasses != 2:
            raise ValueError("two classes are needed")
        trees = tree_nodes(spark, last)
        one, zero = (_sum([_tree_sql(trees[i], features, scaled, _class_share(k)) for i in sorted(trees)]) for k in (1, 0))
        return _evaluated(f"({one} - {zero})", trees)
    if isinstance(last, LogisticRegressionModel):
        p = last.getThreshold()
        if last.numClasses != 2 or p != 0.5:
            raise ValueError("two classes and an even threshold are needed")
        scaler = next((s for s in model.stages if isinstance(s, StandardScalerModel)), None)
        shift = scaler.mean.toArray().tolist() if scaler is not None else [0.0] * len(features)
        scale = [1.0 / s if s else 0.0 for s in scaler.std.toArray().tolist()] if scaler is not None else [1.0] * len(features)
        terms = [f"(`{f}` - {_double(m)}) * {_double(s)} * {_double(c)}"
                 for f, m, s, c in zip(features, shift, scale, last.coefficients.toArray().tolist(), strict=True)]
        return _sum([*terms, _double(last.intercept)])
    if isinstance(last, NaiveBayesModel):
        if last.getModelType() != "multinomial" or last.numClasses != 2:
            raise ValueError("a multinomial model of two classes is needed")
        prior, theta = last.pi.toArray().tolist(), last.theta.toArray().tolist()
        per_class = [_sum([_double(prior[k]), *[f"`{f}` * {_double(t)}" for f, t in zip(features, theta[k], strict=True)]])
                     for k in (0, 1)]
        return f"({per_class[1]} - {per_class[0]})"
    raise ValueError(f"no expression for {type(last).__name__}")


def _features(model: PipelineModel) -> list[str]:
    return next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()


def prediction_sql(spark: SparkSession, model: PipelineModel) -> str:
    """SQL text of the pipeline's prediction (0.0 or 1.0) over its feature columns."""
    known = " AND ".join(f"`{f}` IS NOT NULL" for f in _features(model))
    return f"CASE WHEN {known} THEN CASE WHEN {margin_sql(spark, model)} > 0D THEN 1D ELSE 0D END END"


def score_with_sql(model: PipelineModel, df: DataFrame, prediction: str = "prediction") -> DataFrame:
    """``df`` with the pipeline's prediction as a plain expression."""
    return df.withColumn(prediction, e(prediction_sql(df.sparkSession, model)))


def splits(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """(tree, node, feature, threshold, gain, prediction, is_leaf): the nodes of a
    fitted tree pipeline as rows, thresholds in the features' own units."""
    features, last = _features(model), model.stages[-1]
    scaled = _scaling(model, len(features))
    rows = []
    for tree, nodes in tree_nodes(spark, last).items():
        for i, n in nodes.items():
            leaf = n["leftChild"] < 0
            f = None if leaf else n["split"]["featureIndex"]
            limit = None if leaf else raw_threshold(scaled[f], n["split"]["leftCategoriesOrThreshold"][0])
            rows.append((int(tree), int(i), None if leaf else features[f], limit, None if leaf else float(n["gain"]),
                         float(n["prediction"]), leaf))
    return spark.createDataFrame(
        rows, "tree int, node int, feature string, threshold double, gain double, prediction double, is_leaf boolean")


# --- naive Bayes parameters ---------------------------------------------------

def naive_bayes_parameters(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """(class, feature, log_prior, log_likelihood): one row per class and feature
    of a fitted multinomial naive Bayes pipeline."""
    last, features = model.stages[-1], _features(model)
    prior, theta = last.pi.toArray().tolist(), last.theta.toArray().tolist()
    rows = [(k, f, prior[k], theta[k][i]) for k in range(len(prior)) for i, f in enumerate(features)]
    return spark.createDataFrame(rows, T.StructType([
        T.StructField("class", T.IntegerType()), T.StructField("feature", T.StringType()),
        T.StructField("log_prior", T.DoubleType()), T.StructField("log_likelihood", T.DoubleType())]))
