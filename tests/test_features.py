"""Feature table: hand fixtures with known answers and equivalence of the
production form with the join form on random logs."""

import pytest
from pyspark.sql import functions as F

from conftest import event, make_log, random_log
from userflow.operators.features import feature_table, feature_table_literal
from userflow.operators.windows import CutoffPlan, expand_offsets
from userflow.sources.schema import DAY_MS, LOG_PAGES, feature_columns

C = 1_706_400_000_000
PLAN = CutoffPlan(C, look_back_days=14, look_ahead_days=1)
B, L = PLAN.back_ms, PLAN.ahead_ms


def _one(df, **where):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]


def test_boundary(spark):
    log = make_log(spark, [
        event("u", C - B - 1, "NextSong"),
        event("u", C - B, "NextSong"),
        event("u", C - 1, "Home"),
        event("u", C, "Cancellation Confirmation"),
        event("u", C + L - 1, "Submit Upgrade"),
        event("u", C + L, "Submit Downgrade"),
    ])
    for fn in (feature_table, feature_table_literal):
        r = _one(fn(log, PLAN, LOG_PAGES))
        assert (r.cnt_ns, r.cnt_ho) == (1, 1)
        assert (r.churn, r.upgrade, r.downgrade) == (1, 1, 0)
        assert r.userId == "u_x0" and r.base_user == "u"


def test_ties_last(spark):
    log = make_log(spark, [
        event("u", C - 10, level="free"),
        event("u", C - 5, level="paid", gender="F"),
        event("u", C - 5, level="free", gender="M"),
    ])
    one = feature_table(log, PLAN, LOG_PAGES, ties="one").collect()
    assert len(one) == 1 and one[0].last_paid == 1 and one[0].last_female == 1
    all_ = feature_table(log, PLAN, LOG_PAGES, ties="all").collect()
    assert sorted((r.last_paid, r.last_female) for r in all_) == [(0, 0), (1, 1)]


def test_ties_session_weighted_depth(spark):
    log = make_log(spark, [
        event("u", C - 100, session=1, item=0),
        event("u", C - 90, session=1, item=4),
        event("u", C - 80, session=1, item=4),
        event("u", C - 70, session=2, item=1),
    ])
    for fn in (feature_table, feature_table_literal):
        r = _one(fn(log, PLAN, LOG_PAGES))
        assert r.avg_session_depth == pytest.approx((4 + 4 + 1) / 3)


def test_null_values(spark):
    log = make_log(spark, [
        event("u", C - 100, None, None, None, None, None, None, None),
        event("u", C - 50, "NextSong", None, None, "paid", "F", None, None),
    ])
    for fn in (feature_table, feature_table_literal):
        r = _one(fn(log, PLAN, LOG_PAGES))
        assert r.tenure_days == 0.0 and r.total_length == 0.0 and r.avg_session_depth == 0.0
        assert r.cnt_ns == 1 and r.last_paid == 1


def test_tenure_and_length(spark):
    reg = C - 10 * DAY_MS
    log = make_log(spark, [
        event("u", C - 100, registration=reg, length=1.25),
        event("u", C - 50, registration=reg, length=2.5),
    ])
    r = _one(feature_table(log, PLAN, LOG_PAGES))
    assert r.tenure_days == pytest.approx(10.0) and r.total_length == pytest.approx(3.75)


def test_anonymous_users_dropped(spark):
    log = make_log(spark, [event("", C - 5), event(None, C - 5), event("a", C - 5)])
    assert [r.base_user for r in feature_table(log, PLAN, LOG_PAGES).collect()] == ["a"]


def test_late_only_absent_early_only_zero_labels(spark):
    log = make_log(spark, [event("late", C + 5, "Cancellation Confirmation"), event("early", C - 5)])
    rows = feature_table(log, PLAN, LOG_PAGES).collect()
    assert [(r.base_user, r.churn, r.upgrade, r.downgrade) for r in rows] == [("early", 0, 0, 0)]


def test_repeat_offsets_ids(spark):
    plan = CutoffPlan(C, 14, 1, n_extra=2, interval_days=1)
    log = make_log(spark, [event("u", C - 3 * DAY_MS + 5)])
    ids = sorted(r.userId for r in feature_table(log, plan, LOG_PAGES).collect())
    assert ids == ["u_x0", "u_x1", "u_x2"]


@pytest.mark.parametrize("plan", [
    CutoffPlan(1_700_000_000_000 // DAY_MS * DAY_MS + 15 * DAY_MS, 7, 2, n_extra=4, interval_days=1),
    CutoffPlan(1_700_000_000_000 // DAY_MS * DAY_MS + 20 * DAY_MS, 10, 3, n_extra=3, interval_days=2),
    CutoffPlan(1_700_000_000_000 // DAY_MS * DAY_MS + 18 * DAY_MS + 3_600_000 * 5, 5, 1, n_extra=2,
               interval_days=4),
])
def test_production_form_equals_join_form(spark, plan):
    log = random_log(spark)
    a = feature_table(log, plan, LOG_PAGES)
    b = feature_table_literal(log, plan, LOG_PAGES)
    assert a.count() > 0
    assert a.exceptAll(b).count() == 0
    assert b.exceptAll(a).count() == 0


def test_feature_order_and_types(spark):
    log = random_log(spark, n=300)
    df = feature_table(log, CutoffPlan(1_700_000_000_000 // DAY_MS * DAY_MS + 15 * DAY_MS, 7, 2), LOG_PAGES)
    assert df.columns[4:30] == feature_columns()
    types = dict(df.dtypes)
    assert types["cnt_ns"] == "bigint" and types["tenure_days"] == "double" and types["churn"] == "int"


def test_features_ignore_events_after_cutoff(spark):
    base = [event("u", C - 100, "Home")]
    extra = [event("u", C + 1, "Home"), event("u", C + 2 * DAY_MS, "Cancellation Confirmation")]
    a = feature_table(make_log(spark, base), PLAN, LOG_PAGES).drop("churn")
    b = feature_table(make_log(spark, base + extra), PLAN, LOG_PAGES).drop("churn")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_expand_offsets_matches_window_definition(spark):
    plan = CutoffPlan(C, 3, 2, n_extra=4, interval_days=2)
    ts = [C + k * 3_600_000 * 7 for k in range(-40, 10)]
    log = make_log(spark, [event("u", t) for t in ts])
    got = {(r.ts, r.offset_idx, r.in_train) for r in expand_offsets(log, plan).collect()}
    want = set()
    for t in ts:
        for i in range(plan.n_extra + 1):
            c = plan.cutoff(i)
            if c - plan.back_ms <= t < c + plan.ahead_ms:
                want.add((t, i, t < c))
    assert got == want


def test_plan_has_no_python_and_no_pairwise_join(spark):
    log = random_log(spark, n=200)
    df = feature_table(log, PLAN, LOG_PAGES)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "Window"):
        assert bad not in plan, bad
    assert F is not None


def test_prior_churn_kept_by_default_and_dropped_on_request(spark):
    plan = CutoffPlan(C, 14, 1, n_extra=2, interval_days=1)
    log = make_log(spark, [
        event("a", C - 30 * DAY_MS, "Cancellation Confirmation"),  # long before every window
        event("a", C - 5),
        event("b", C - DAY_MS - 5, "Cancellation Confirmation"),    # before cutoff 0 only
        event("b", C - 3 * DAY_MS),
        event("c", C - 5),
    ])
    keep = {r.userId for r in feature_table(log, plan, LOG_PAGES).collect()}
    assert {"a_x0", "b_x0", "c_x0"} <= keep
    drop = {r.userId for r in feature_table(log, plan, LOG_PAGES, exclude_prior_churn=True).collect()}
    assert not any(u.startswith("a_") for u in drop)
    assert "b_x0" not in drop and "b_x2" in drop and "c_x0" in drop


def test_hot_user_holding_a_third_of_rows(spark):
    from pyspark.sql import functions as F2

    log = random_log(spark, seed=11, n=6000)
    hot = log.withColumn("userId", F2.when(F2.rand(3) < 1 / 3, F2.lit("hot")).otherwise(F2.col("userId")))
    hot = spark.createDataFrame(hot.collect(), log.schema)  # freeze the random assignment
    plan = CutoffPlan(1_700_000_000_000 // DAY_MS * DAY_MS + 15 * DAY_MS, 7, 2, n_extra=4, interval_days=1)
    a = feature_table(hot, plan, LOG_PAGES)
    b = feature_table_literal(hot, plan, LOG_PAGES)
    assert a.where("base_user = 'hot'").count() == 5
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_behaviour_fast_path_equals_join_form(spark):
    from userflow.operators.features import behaviour, behaviour_features, windowed_rows

    log = random_log(spark, seed=3)
    plan = CutoffPlan(1_700_000_000_000 // DAY_MS * DAY_MS + 16 * DAY_MS + 7 * 3_600_000, 6, 2, 3, 2)
    a = behaviour_features(log, plan, LOG_PAGES)
    b = behaviour(windowed_rows(log, plan).where("in_train"), LOG_PAGES)
    assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("plan", [
    CutoffPlan(1_700_000_000_000 // DAY_MS * DAY_MS + 15 * DAY_MS, 7, 2, n_extra=4, interval_days=1),
    CutoffPlan(1_700_000_000_000 // DAY_MS * DAY_MS + 18 * DAY_MS + 3_600_000 * 5, 5, 3, n_extra=2, interval_days=4),
])
def test_per_part_tables_equal_join_form_parts(spark, plan):
    from userflow.operators import features as fx

    log = random_log(spark, seed=5)
    rows = fx.windowed_rows(log, plan)
    train, ahead = rows.where("in_train"), rows.where("NOT in_train")
    pairs = [
        (fx.session_depth_table(log, plan), fx.session_depth(train)),
        (fx.last_state_table(log, plan), fx.last_state(train)),
        (fx.labels_table(log, plan, LOG_PAGES), fx.lifecycle_labels(ahead, LOG_PAGES)),
    ]
    for a, b in pairs:
        assert a.count() > 0
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_joined_parts_equal_feature_table(spark):
    from userflow.operators import features as fx

    log = random_log(spark, seed=9)
    plan = CutoffPlan(1_700_000_000_000 // DAY_MS * DAY_MS + 17 * DAY_MS, 9, 2, n_extra=3, interval_days=2)
    a = fx._finish(fx.joined_parts(log, plan, LOG_PAGES))
    b = fx.feature_table(log, plan, LOG_PAGES)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("seed", [2, 4])
def test_ties_all_production_equals_join_form(spark, seed):
    log = random_log(spark, seed=seed, n=4000)  # whole hours: many ties at the last ts
    plan = CutoffPlan(1_700_000_000_000 // DAY_MS * DAY_MS + 16 * DAY_MS, 6, 2, n_extra=3, interval_days=2)
    a = feature_table(log, plan, LOG_PAGES, ties="all")
    b = feature_table_literal(log, plan, LOG_PAGES, ties="all")
    assert a.count() > feature_table(log, plan, LOG_PAGES).count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
