"""Pipelines: assembler order, separable data, importances, persistence."""

import pytest
from pyspark.ml import PipelineModel

from userflow.operators.evaluate import metrics
from userflow.operators.features import FEATURES
from userflow.plans.modeling import build_pipeline, importances, make_classifier, save_model, score
from userflow.plans.transformer import WindowedFeatures
from userflow.sources.schema import LOG_PAGES


@pytest.fixture(scope="module")
def separable(spark):
    rows = []
    for i in range(120):
        y = i % 2
        vals = [float((i * 7 + j) % 5) for j in range(len(FEATURES))]
        vals[FEATURES.index("cnt_cc")] = 10.0 + i % 3 if y else float(i % 3)
        rows.append((f"u{i}", y, *vals))
    schema = "userId string, churn int, " + ", ".join(f"{f} double" for f in FEATURES)
    return spark.createDataFrame(rows, schema)


def test_assembler_order(spark):
    p = build_pipeline("churn")
    assert p.getStages()[0].getInputCols() == FEATURES
    assert len(FEATURES) == 26


def test_separable_gbt_and_importance(spark, separable):
    model = build_pipeline("churn", "gbt", maxIter=3, maxDepth=3).fit(separable)
    m = metrics(model.transform(separable), "churn").collect()[0]
    assert m.f1 == 1.0
    top = importances(spark, model).orderBy("rank").first()
    assert top.feature == "cnt_cc" and top.rank == 1


@pytest.mark.parametrize("kind", ["rf", "lr", "dt", "nb"])
def test_other_classifiers_fit(spark, separable, kind):
    model = build_pipeline("churn", kind).fit(separable)
    assert model.transform(separable).where("prediction = churn").count() >= 100


def test_unknown_classifier():
    with pytest.raises(ValueError):
        make_classifier("svm", "churn")


def test_save_load_same_predictions(spark, separable, tmp_path):
    model = build_pipeline("churn", "dt").fit(separable)
    path = save_model(spark, model, str(tmp_path / "m"))
    a = model.transform(separable).select("userId", "prediction")
    b = score(path, separable).select("userId", "prediction")
    assert a.exceptAll(b).count() == 0
    assert isinstance(PipelineModel.load(path), PipelineModel)


def test_transformer_persists(spark, tmp_path):
    t = WindowedFeatures(cutoffMs=1_706_400_000_000, lookBackDays=14, lookAheadDays=1, extraOffsets=6)
    t.write().overwrite().save(str(tmp_path / "t"))
    back = WindowedFeatures.load(str(tmp_path / "t"))
    assert back.plan() == t.plan() and back.pages() == LOG_PAGES


def test_scoring_model_with_feature_stage(spark, tmp_path):
    from conftest import random_log
    from userflow.operators.windows import CutoffPlan
    from userflow.plans.modeling import scoring_model, score_log
    from userflow.operators.features import feature_table
    from userflow.sources.schema import DAY_MS

    log = random_log(spark, n=1500)
    c = 1_700_000_000_000 // DAY_MS * DAY_MS + 15 * DAY_MS
    stage = WindowedFeatures(cutoffMs=c, lookBackDays=7, lookAheadDays=2, extraOffsets=2)
    feats = stage.transform(log)
    fitted = build_pipeline("churn", "dt", maxDepth=3).fit(feats)
    path = save_model(spark, scoring_model(stage, fitted), str(tmp_path / "scoring"))
    a = fitted.transform(feature_table(log, CutoffPlan(c, 7, 2, 2), LOG_PAGES)).select("userId", "prediction")
    b = score_log(path, log).select("userId", "prediction")
    assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    moved = score_log(path, log, cutoff_ms=c - DAY_MS).select("cutoff_ms").distinct().collect()
    assert max(r.cutoff_ms for r in moved) == c - DAY_MS


def test_train_and_score_flow(spark, tmp_path):
    from conftest import random_log
    from userflow.operators.windows import CutoffPlan
    from userflow.plans.flow import RunSettings, score, train
    from userflow.sources.schema import DAY_MS

    log = random_log(spark, n=2500)
    c = 1_700_000_000_000 // DAY_MS * DAY_MS + 15 * DAY_MS
    s = RunSettings(plan=CutoffPlan(c, 7, 2, 3, 1), kind="gbt", params={"maxIter": 3, "maxDepth": 3},
                    split_seed=27, rebalance_seed=271)
    path, report = train(spark, log, s, str(tmp_path / "flow"))
    rows = {r.dataset: r for r in report.collect()}
    assert set(rows) == {"test", "train", "rebalanced"}
    assert all(r.total > 0 for r in rows.values())
    m = score(path, log, "churn").collect()[0]
    assert m.total == feature_count(spark, log, s)


def feature_count(spark, log, s):
    from userflow.operators.features import feature_table

    return feature_table(log, s.plan, s.pages).count()


@pytest.mark.parametrize("kind", ["gbt", "rf", "lr", "dt", "nb"])
def test_every_classifier_can_be_swept(spark, separable, kind):
    from userflow.plans.modeling import sweep

    report = sweep(separable, {"train": separable}, "churn", [(2, 2)], kind=kind).collect()
    assert [(r.rounds, r.depth, r.total) for r in report] == [(2, 2, 120)]


def test_plan_from_history_and_written_scores(spark, tmp_path):
    from conftest import random_log
    from userflow.plans.flow import RunSettings, planned, score_rows, train
    from userflow.sources.schema import DAY_MS

    log = random_log(spark, n=2500)
    plan = planned(log, 7, 2, 4)
    assert plan.n_extra >= 1 and plan.end_ms % DAY_MS == 0
    assert planned(log, 7, 2, 4, cutoff_ms=plan.cutoff_ms - DAY_MS, extra=0).n_extra == 0
    s = RunSettings(plan=planned(log, 7, 2, 4, extra=1), kind="dt", params={"maxDepth": 3}, split_seed=27, rebalance_seed=271)
    path, report = train(spark, log, s, str(tmp_path / "m"))
    row = report.first()
    assert row.classifier == "dt" and row.cutoff_ms == plan.cutoff_ms and row.fit_seconds >= 0
    score_rows(path, log, str(tmp_path / "scores"))
    back = spark.read.parquet(str(tmp_path / "scores"))
    assert back.columns == ["userId", "base_user", "offset_idx", "cutoff_ms", "prediction"]
    assert back.count() == feature_count(spark, log, s)
