"""Loaders, the test-table adapter, cleaning and exploration operators."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, event, make_log
from userflow.operators import clean, explore
from userflow.operators.ordering import position_in_group
from userflow.operators.windows import plan_offsets
from userflow.sources.events import load_activity
from userflow.sources.schema import LOG_PAGES, check_schema
from userflow.sources.tables import activity_from_tables


def test_json_loader_declared_schema(spark, tmp_path):
    p = tmp_path / "log.json"
    rows = [
        {"userId": "1", "ts": 1000, "page": "NextSong", "sessionId": 3, "itemInSession": 0, "level": "paid",
         "gender": "F", "registration": 10, "length": 200},
        {"userId": "", "ts": 2000, "page": "Home", "sessionId": 3, "itemInSession": 1, "level": "free"},
    ]
    p.write_text("\n".join(json.dumps(r) for r in rows))
    df = load_activity(spark, str(p))
    check_schema(df)
    got = df.orderBy("ts").collect()
    assert got[0].length == 200.0 and got[1].registration is None


def test_check_schema_rejects_wrong_type(spark):
    df = spark.createDataFrame([("1", "x")], "userId string, ts string")
    with pytest.raises(ValueError):
        check_schema(df)


def test_adapter_independent_of_session_time_zone(spark):
    base = activity_from_tables(spark, SF_SMALL, ["ts", "registration"]).collect()
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        other = activity_from_tables(spark, SF_SMALL, ["ts", "registration"]).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert sorted(base) == sorted(other)


def test_adapter_column_subset_skips_joins(spark):
    df = activity_from_tables(spark, SF_SMALL, ["ts"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "customer" not in plan and "orders" not in plan and "Window" not in plan


def test_position_in_group_matches_row_number(spark):
    from pyspark.sql import Window

    rows = [(g, t, k) for g in range(3) for t in range(0, 400, 7) for k in range(2)]
    df = spark.createDataFrame(rows, "g long, t long, k long")
    got = position_in_group(df, ["g"], ["t", "k"], "pos", split=F.floor(F.col("t") / 50))
    want = df.withColumn("pos", F.row_number().over(Window.partitionBy("g").orderBy("t", "k")) - 1)
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_clean_anonymous_and_excluded(spark):
    log = make_log(spark, [event("", 1), event(None, 2), event("1261737", 3), event("5", 4)])
    assert sorted(r.userId for r in clean.drop_anonymous(log).collect()) == ["1261737", "5"]
    assert sorted(r.userId for r in clean.exclude_users(log, ["1261737"]).collect()) == ["", "5"]


def test_missing_registration_and_null_profile(spark):
    log = make_log(spark, [event("a", 1, registration=None), event("a", 2), event("b", 3)])
    assert [r.userId for r in clean.missing_registration(log).collect()] == ["a"]
    r = clean.null_profile(log).collect()[0]
    assert r.n_rows == 3 and r.null_registration == 1 and r.null_length == 3


def test_first_last_events_keep_ties(spark):
    log = make_log(spark, [event("a", 1, level="paid"), event("a", 1, level="free"), event("a", 5)])
    assert explore.first_events(log).count() == 2
    assert explore.last_events(log).count() == 1
    counts = {r.level: r.n for r in explore.entry_level(log).collect()}
    assert counts == {"paid": 1, "free": 1}


def test_lifecycle_flags_and_profile(spark):
    log = make_log(spark, [
        event("a", 1, "Cancellation Confirmation", gender="F"),
        event("a", 2, "Home", level="paid", gender="F"),
        event("b", 3, "Submit Upgrade"),
    ])
    flags = {r.userId: (r.churn, r.upgrade, r.downgrade) for r in explore.user_flags(log, LOG_PAGES).collect()}
    assert flags == {"a": ("Yes", "No", "No"), "b": ("No", "Yes", "No")}
    assert explore.with_lifecycle_flags(log, LOG_PAGES).where("churn = 'Yes'").count() == 2
    prof = {r.userId: r.level for r in explore.user_profile(log, LOG_PAGES).collect()}
    assert prof == {"a": "paid", "b": "free"}


def test_page_frequency_counts_null_page_as_zero(spark):
    log = make_log(spark, [event("a", 1, None), event("a", 2, "Home"), event("a", 3, "Home")])
    got = {r.page: r.n for r in explore.page_frequency(log).collect()}
    assert got == {"Home": 2, None: 0}


def test_plan_offsets(spark):
    day = 86_400_000
    log = make_log(spark, [event("a", 10 * day + 5), event("a", 71 * day + 5)])
    r = plan_offsets(log, 21, 7, 4).collect()[0]
    assert r.history_days == 62 and r.n_extra == (62 - 7 - 21) // 4
    assert r.cutoff_ms == (71 + 1 - 7) * day


def test_exact_percentiles_match_percentile(spark):
    import random

    rng = random.Random(5)
    rows = [(g, rng.choice([None] + list(range(0, 10_000, 7)))) for g in ("a", "b", "c") for _ in range(300)]
    rows += [("d", 42)] + [("e", 5)] * 200 + [("e", 9_000)] * 199 + [(None, 7), (None, 8)]  # half of e holds one value
    df = spark.createDataFrame(rows, "g string, v long")
    got = {r.g: r for r in explore.exact_percentiles(df, "g", "v", split_width=500).collect()}
    want = df.groupBy("g").agg(F.percentile("v", F.array(*[F.lit(x) for x in explore.QUANTILES])).alias("p")).collect()
    for r in want:
        cols = [f"p{int(round(x * 100)):02d}" for x in explore.QUANTILES]
        assert [round(getattr(got[r.g], c), 6) for c in cols] == [round(x, 6) for x in r.p]
