"""Compiled classifiers, parameters as rows, sweeps in one feature pass,
permutation importance, and pipelines loaded in another process."""

import math
import os
import subprocess
import sys

import pytest
from pyspark.ml.functions import vector_to_array

from conftest import SF_SMALL, random_log
from userflow.operators import importance
from userflow.operators.features import FEATURES, feature_table
from userflow.operators.windows import CutoffPlan
from userflow.plans import modeling, score_sql
from userflow.session import materialize, shared_dir
from userflow.sources.schema import DAY_MS, LOG_PAGES

C = 1_700_000_000_000 // DAY_MS * DAY_MS + 15 * DAY_MS


@pytest.fixture(scope="module")
def table(spark):
    log = random_log(spark, n=2500)
    return materialize(feature_table(log, CutoffPlan(C, 7, 2, 3, 1), LOG_PAGES).fillna(0))


@pytest.mark.parametrize("kind, params", [
    ("gbt", {"maxIter": 12, "maxDepth": 6}), ("rf", {"numTrees": 9, "maxDepth": 6, "seed": 5}), ("dt", {"maxDepth": 8}),
    ("lr", {}), ("nb", {})])
def test_expression_equals_transform(spark, table, kind, params):
    model = modeling.build_pipeline("churn", kind, **params).fit(table)
    want = model.transform(table)
    both = score_sql.score_with_sql(model, want, "by_sql")
    assert both.where("by_sql <> prediction or by_sql is null").count() == 0
    assert 0 < both.where("by_sql = 1").count() < both.count()
    plan = score_sql.score_with_sql(model, table).select("userId", "prediction")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "UDF" not in plan and "vector" not in plan.lower().replace("columnartorow", "")


def test_boosted_margin_equals_raw_prediction(spark, table):
    model = modeling.build_pipeline("churn", "gbt", maxIter=8, maxDepth=5).fit(table)
    scored = model.transform(table).selectExpr("*", f"{score_sql.margin_sql(spark, model)} as margin")
    rows = scored.select("margin", vector_to_array("rawPrediction")[1].alias("raw")).collect()
    assert all(math.isclose(r.margin, r.raw, rel_tol=1e-12, abs_tol=1e-12) for r in rows)


def test_null_features_have_null_predictions(spark, table):
    model = modeling.build_pipeline("churn", "dt", maxDepth=3).fit(table)
    gone = table.limit(5).selectExpr("* except (cnt_cc)", "cast(null as bigint) as cnt_cc")
    assert [r.prediction for r in score_sql.score_with_sql(model, gone).collect()] == [None] * 5


def test_raw_thresholds_decide_as_scaled_ones():
    for shift, scale in ((0.0, 1.0), (1e6, 1e-3), (-3.25, 7e8), (0.1, 0.0)):
        scaled = lambda x: (x - shift) * scale
        for t in (-1e9, -1.5, -0.0, 0.0, 1e-300, 0.3, 12345.678):
            limit = score_sql.raw_threshold(scaled, t)
            if limit is None:
                assert scaled(-1.7976931348623157e308) > t
                continue
            assert scaled(limit) <= t
            above = math.nextafter(limit, math.inf)
            assert above == math.inf or scaled(above) > t


def test_naive_bayes_parameters_in_closed_form(spark, table):
    rows = score_sql.naive_bayes_parameters(spark, modeling.build_pipeline("churn", "nb").fit(table)).collect()
    assert len(rows) == 2 * len(FEATURES)
    data = table.select("churn", *FEATURES).collect()
    for r in rows:
        mine = [x for x in data if x.churn == r["class"]]
        total = sum(float(x[f]) for x in mine for f in FEATURES)
        assert math.isclose(r.log_prior, math.log(len(mine) + 1) - math.log(len(data) + 2), rel_tol=1e-9)
        own = sum(float(x[r.feature]) for x in mine)
        assert math.isclose(r.log_likelihood, math.log(own + 1) - math.log(total + len(FEATURES)), rel_tol=1e-9, abs_tol=1e-9)


def test_sweep_fits_all_points_on_features_written_once(spark, table, monkeypatch):
    grid = [(2, 2), (4, 3), (3, 1)]
    written = []

    def counted(df):
        out = materialize(df)
        written.append(out)
        return out

    monkeypatch.setattr(modeling, "materialize", counted)
    points = modeling.fit_grid(table, "churn", grid, "gbt", parallelism=3)
    assert len(written) == 1 and all(shared_dir(spark).rstrip("/").split("/")[-1] in f for f in written[0].inputFiles())
    assert [(p.rounds, p.depth) for p in points] == grid
    assert [(p.model.stages[-1].getNumTrees, p.model.stages[-1].trees[0].depth <= p.depth) for p in points] == [(2, True), (4, True), (3, True)]
    got = {(r.rounds, r.depth, r.dataset): r for r in modeling.evaluate_grid(points, {"all": table, "one": table.where("offset_idx = 1")}, "churn").collect()}
    assert len(got) == 6
    for p in points:
        for name, rows in (("all", table), ("one", table.where("offset_idx = 1"))):
            want = modeling.metrics(p.model.transform(rows), "churn").head()
            assert all(got[p.rounds, p.depth, name][c] == want[c] for c in ("tp", "tn", "fp", "fn"))


def _brute_importance(rows, label, rule, features, key, seed, buckets):
    import hashlib

    def h(r):
        return int(hashlib.md5(f"{r[key]}|{seed}".encode()).hexdigest()[:8], 16)

    donors = {}
    for b in range(buckets):
        mine = sorted((r for r in rows if h(r) % buckets == b), key=lambda r: (h(r), r[key]))
        for r, d in zip(mine, [*mine[1:], *mine[:1]]):
            donors[r[key]] = d

    def accuracy(f):
        return sum(rule({**r, **({f: donors[r[key]][f]} if f else {})}) == r[label] for r in rows) / len(rows)

    return {f: (accuracy(None), accuracy(f)) for f in features}


def test_permutation_importance_matches_brute_force(spark):
    rows = [{"id": f"k{i}", "y": int(i % 3 == 0), "a": float(i % 3), "b": float(i % 5), "c": 1.0} for i in range(200)]
    df = spark.createDataFrame(rows)
    sql = "CASE WHEN a = 0 AND b < 4.5 + c THEN 1.0 ELSE 0.0 END"
    got = importance.permutation_importance(df, "y", sql, ["a", "b", "c"], "id", 3, 5).collect()
    want = _brute_importance(rows, "y", lambda r: int(r["a"] == 0 and r["b"] < 4.5 + r["c"]), ["a", "b", "c"], "id", 3, 5)
    assert all((r.baseline_accuracy, r.permuted_accuracy) == pytest.approx(want[r.feature]) for r in got) and len(got) == 3
    assert [r.feature for r in sorted(got, key=lambda r: r["rank"])] == ["a", "b", "c"]
    again = importance.permutation_importance(df.repartition(7), "y", sql, ["a", "b", "c"], "id", 3, 5)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, got))
    assert importance.permutation_importance(df.limit(0), "y", sql, ["a"], "id", 3).collect()[0].importance is None


def test_importance_of_a_compiled_model(spark):
    rows = [(f"u{i}", i % 2, *[float((i * 7 + j) % 5) + (10.0 * (i % 2) if f == "cnt_cc" else 0.0) for j, f in enumerate(FEATURES)])
            for i in range(120)]
    df = spark.createDataFrame(rows, "userId string, churn int, " + ", ".join(f"{f} double" for f in FEATURES))
    model = modeling.build_pipeline("churn", "gbt", maxIter=3, maxDepth=3).fit(df)
    found = importance.permutation_importance(df, "churn", score_sql.prediction_sql(spark, model), FEATURES, "userId", 1)
    top = found.orderBy("rank").first()
    assert top.feature == "cnt_cc" and top.importance > 0.2


def test_saved_pipeline_scores_alike_in_another_process(spark, tmp_path):
    from userflow.plans import ml_queries

    path = ml_queries.save_scaler_pipeline(spark, SF_SMALL, str(tmp_path / "model"))
    script = f"""
import sys; sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from userflow.session import build_session
spark = build_session(master="local[2]", shuffle_partitions=2, app="other-process")
from userflow.plans import modeling, ml_queries, registry
log = registry.act(spark, {SF_SMALL!r}, between=registry.plan_days(registry.PLAN))
from pyspark.ml.functions import vector_to_array
modeling.score_log({path!r}, log).select("userId", vector_to_array("features").alias("v")).write.parquet({str(tmp_path / "out")!r})
"""
    subprocess.run([sys.executable, "-c", script], check=True, timeout=300, capture_output=True)
    there = {r.userId: list(r.v) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    here = {r.userId: [r[f] for f in FEATURES] for r in ml_queries.q_saved_scaler_pipeline(spark, SF_SMALL).collect()}
    assert set(there) == set(here) and here
    assert all(round(a, 6) + 0.0 == pytest.approx(b, abs=1e-6) for u in here for a, b in zip(there[u], here[u]))
