"""Stored day partials, logs stored by user, and runtime filters of id sets."""

import pytest
from pyspark.sql import functions as F

from conftest import event, make_log, random_log
from userflow.operators import explore, features, sampling
from userflow.operators.windows import CutoffPlan
from userflow.plans import day_store
from userflow.session import materialize
from userflow.sources import user_buckets
from userflow.sources.schema import DAY_MS, LOG_PAGES

START = 1_700_000_000_000 // DAY_MS * DAY_MS
PLAN = CutoffPlan(START + 15 * DAY_MS, 7, 2, 4, 1)


def _same(a, b):
    assert a.columns == b.columns
    a, b = materialize(a), materialize(b)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.count() > 0


@pytest.fixture(scope="module")
def log(spark):
    return materialize(random_log(spark, n=4000))


def test_day_store_equals_feature_table_after_appends(spark, log, tmp_path):
    path = str(tmp_path / "store")
    day = F.expr(f"ts div {DAY_MS}")
    cut = START // DAY_MS + 9
    day_store.store_days(log.where(day < cut), path, LOG_PAGES)
    day_store.store_days(log.where(day > cut), path, LOG_PAGES)
    for part in (0, 1, 2):  # one day arrives in three pieces, sessions split between them
        day_store.store_days(log.where((day == cut) & (F.expr("pmod(ts div 3600000, 3)") == part)), path, LOG_PAGES)
    for plan in (PLAN, CutoffPlan(START + 12 * DAY_MS, 5, 3, 2, 2), CutoffPlan(START + 40 * DAY_MS, 30, 1)):
        _same(day_store.feature_table_from_days(spark, path, plan), features.feature_table(log, plan, LOG_PAGES))
    before = spark.read.parquet(f"{path}/days").count()
    day_store.compact(spark, path, cut, cut)
    assert spark.read.parquet(f"{path}/days").count() < before
    _same(day_store.feature_table_from_days(spark, path, PLAN), features.feature_table(log, PLAN, LOG_PAGES))


def test_a_replaced_day_counts_once(spark, log, tmp_path):
    path = str(tmp_path / "store")
    day = F.expr(f"ts div {DAY_MS}")
    cut = START // DAY_MS + 11
    day_store.store_days(log, path, LOG_PAGES)
    other = random_log(spark, seed=8, n=4000)
    day_store.store_days(other.where(day == cut), path, LOG_PAGES, mode="replace_days")
    now = log.where(day != cut).unionByName(other.where(day == cut))
    _same(day_store.feature_table_from_days(spark, path, PLAN), features.feature_table(now, PLAN, LOG_PAGES))
    with pytest.raises(ValueError):
        day_store.store_days(log, path, LOG_PAGES, mode="overwrite")


def test_days_outside_the_windows_are_not_read(spark, log, tmp_path):
    path = str(tmp_path / "store")
    day_store.store_days(log, path, LOG_PAGES)
    plan = CutoffPlan(START + 15 * DAY_MS, 3, 1)
    text = day_store.feature_table_from_days(spark, path, plan)._jdf.queryExecution().executedPlan().toString()
    first = START // DAY_MS + 12
    assert text.count("PartitionFilters: [isnotnull(day") == 2 and f">= {first}" in text and f"<= {first + 3}" in text
    with pytest.raises(ValueError):
        day_store.feature_table_from_days(spark, path, CutoffPlan(START + 1, 3, 1))


def test_day_store_of_anonymous_and_empty_logs(spark, tmp_path):
    rows = [event("", START), event(None, START), event("a", START + 5, page="Home", session=None, item=None)]
    path = str(tmp_path / "store")
    day_store.store_days(make_log(spark, rows), path, LOG_PAGES)
    day_store.store_days(make_log(spark, []), path, LOG_PAGES)
    plan = CutoffPlan(START + DAY_MS, 2, 1)
    _same(day_store.feature_table_from_days(spark, path, plan), features.feature_table(make_log(spark, rows), plan, LOG_PAGES))


def test_joins_on_bucketed_users_need_no_exchange(spark, log):
    hot = F.when(F.col("userId").cast("int") < 20, F.lit("1")).otherwise(F.col("userId"))
    skewed = materialize(log.withColumn("userId", F.when(F.expr("pmod(ts div 3600000, 11) = 0"), F.lit(None)).otherwise(hot)))
    stored = user_buckets.store_by_user(skewed, "skewed_log", 4, hot_rows=200)
    even, rest = stored.parts(spark)
    assert rest.where("userId = '1'").count() > 200 and rest.where("userId is null").count() > 0
    assert even.where("userId = '1' or userId is null").count() == 0 and even.count() + rest.count() == skewed.count()

    def chain(x, _=False):
        return features._finish(features.joined_parts(x, PLAN, LOG_PAGES, "labels"))

    _same(user_buckets.by_user(spark, stored, chain), chain(skewed))
    for op in (lambda x, known=False: explore.with_lifecycle_flags(x, LOG_PAGES, known_users=known),
               lambda x, known=False: explore.last_events(x, known_users=known)):
        got, want = (materialize(x) for x in (user_buckets.by_user(spark, stored, op), op(skewed)))
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with user_buckets.co_located(spark):
            text = chain(even)._jdf.queryExecution().executedPlan().toString()
            flags = explore.with_lifecycle_flags(even, LOG_PAGES, known_users=True)._jdf.queryExecution().executedPlan().toString()
            last = explore.last_events(even, known_users=True)._jdf.queryExecution().executedPlan().toString()
        plain = chain(skewed)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert text.count("SortMergeJoin") == 3 and "Exchange" not in text
    assert "Exchange" not in flags and "Exchange" not in last
    assert "Exchange" in plain


def test_a_large_id_set_filters_the_scan(spark, tmp_path):
    big = str(tmp_path / "log")
    spark.range(20_000).selectExpr("cast(id % 997 as string) as userId", "id as ts").write.parquet(big)
    ids_path = str(tmp_path / "ids")
    spark.range(400).selectExpr("cast(id * 3 as string) as u").union(spark.sql("select cast(null as string)")).write.parquet(ids_path)
    rows, ids = spark.read.parquet(big), spark.read.parquet(ids_path)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        inside, outside = sampling.split_by_ids(rows, ids)
        assert "might_contain" in inside._jdf.queryExecution().optimizedPlan().toString()
        n_in, n_out = inside.count(), outside.count()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    want = {str(3 * i) for i in range(400)}
    assert n_in == sum(str(i % 997) in want for i in range(20_000)) and n_in + n_out == 20_000
