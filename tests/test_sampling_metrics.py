"""Split, rebalance and metric properties, with hand fixtures for edge cases."""

import pytest
from pyspark.sql import functions as F

from userflow.operators.evaluate import metrics
from userflow.operators.sampling import (
    class_counts, rebalance, rebalance_condition, split_by_ids, split_by_key, split_side,
)


def _users(spark, n=500, pos_every=5):
    rows = [(f"{i % 200}_x{i // 200}", str(i % 200), int(i % pos_every == 0)) for i in range(n)]
    return spark.createDataFrame(rows, "userId string, base_user string, churn int")


def test_split_complete_disjoint_and_user_level(spark):
    df = _users(spark)
    train, test = split_by_key(df, 0.7, 27)
    assert train.count() + test.count() == df.count()
    assert train.join(test, "userId").count() == 0
    # every offset of one person on one side (no leakage)
    assert train.select("base_user").intersect(test.select("base_user")).count() == 0
    share = train.select("base_user").distinct().count() / 200
    assert 0.55 < share < 0.85


def test_split_stable_under_row_order_and_partitioning(spark):
    df = _users(spark)
    a = split_by_key(df, 0.7, 27)[0]
    b = split_by_key(df.repartition(7).orderBy(F.rand(3)), 0.7, 27)[0]
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_split_by_row_key(spark):
    df = _users(spark)
    train, test = split_by_key(df, 0.5, 1, key="row")
    assert train.count() + test.count() == 500
    assert train.select("base_user").intersect(test.select("base_user")).count() > 0


def test_split_by_ids(spark):
    df = _users(spark)
    ids = spark.createDataFrame([("1_x0",), ("2_x0",), ("2_x0",)], "id string")
    mem, non = split_by_ids(df, ids)
    assert sorted(r.userId for r in mem.collect()) == ["1_x0", "2_x0"]
    assert non.count() == 498


def test_rebalance_keeps_minority_and_shrinks_majority(spark):
    df = _users(spark)  # 100 ones, 400 zeros
    out = rebalance(df, "churn", 271)
    counts = {r.churn: r.n for r in class_counts(out, "churn").collect()}
    assert counts[1] == 100
    assert 60 < counts[0] < 140
    assert df.where("churn = 1").exceptAll(out.where("churn = 1")).count() == 0


def test_rebalance_mostly_positive_and_one_class(spark):
    rows = [(f"u{i}", str(i), int(i % 5 != 0)) for i in range(500)]  # 80 % ones
    df = spark.createDataFrame(rows, "userId string, base_user string, churn int")
    counts = {r.churn: r.n for r in class_counts(rebalance(df, "churn", 3), "churn").collect()}
    assert counts[0] == 100 and 60 < counts[1] < 140
    one = spark.createDataFrame([(f"u{i}", str(i), 0) for i in range(20)], "userId string, base_user string, churn int")
    assert rebalance(one, "churn", 3).count() == 20


def test_split_side_tags_the_split_sets(spark):
    df = _users(spark)
    train, test = split_by_key(df, 0.7, 27)
    tagged = df.withColumn("side", split_side(df, 0.7, 27))
    assert tagged.where("side = 'train'").drop("side").exceptAll(train).count() == 0
    assert tagged.where("side = 'test'").drop("side").exceptAll(test).count() == 0
    assert tagged.where("side = 'train'").count() == train.count()


def test_rebalance_condition_is_the_rebalance_filter(spark):
    df = _users(spark)
    keep = rebalance_condition(df, "churn", 271)
    out = rebalance(df, "churn", 271)
    assert df.where(keep).exceptAll(out).count() == 0 and out.exceptAll(df.where(keep)).count() == 0
    one = spark.createDataFrame([("u", "u", 0)], "userId string, base_user string, churn int")
    assert rebalance_condition(one, "churn", 3) is None


def _pred(spark, pairs):
    return spark.createDataFrame([(y, float(p)) for y, p in pairs], "y int, prediction double")


def test_metrics_values(spark):
    r = metrics(_pred(spark, [(1, 1), (1, 0), (0, 0), (0, 0), (0, 1)]), "y").collect()[0]
    assert (r.tp, r.tn, r.fp, r.fn, r.total) == (1, 2, 1, 1, 5)
    assert r.recall == pytest.approx(0.5) and r.precision == pytest.approx(0.5)
    assert r.accuracy == pytest.approx(0.6) and r.f1 == pytest.approx(0.5)


@pytest.mark.parametrize("pairs,expect", [
    ([(0, 0), (0, 1)], {"recall": None, "precision": 0.0, "f1": None}),   # no positives
    ([(1, 0), (0, 0)], {"recall": 0.0, "precision": None, "f1": None}),   # no predicted positives
    ([(1, 1), (0, 0)], {"recall": 1.0, "precision": 1.0, "f1": 1.0, "accuracy": 1.0}),
    ([(1, 0), (0, 1)], {"recall": 0.0, "precision": 0.0, "f1": None, "accuracy": 0.0}),
])
def test_metrics_edges(spark, pairs, expect):
    r = metrics(_pred(spark, pairs), "y").collect()[0].asDict()
    assert r["tp"] + r["tn"] + r["fp"] + r["fn"] == r["total"] == len(pairs)
    for k, v in expect.items():
        assert r[k] == v, (k, r)


def test_metrics_by_group(spark):
    df = _pred(spark, [(1, 1), (0, 0), (1, 0)]).withColumn("dataset", F.lit("a"))
    df = df.unionByName(_pred(spark, [(1, 1)]).withColumn("dataset", F.lit("b")))
    got = {r.dataset: r.total for r in metrics(df, "y", by=["dataset"]).collect()}
    assert got == {"a": 3, "b": 1}
