"""The stored log keeps every row; bad input does not pass unseen."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, event, make_log
from userflow import session
from userflow.operators.explore import last_level_by, user_flags
from userflow.operators.sampling import rebalance, rebalance_condition
from userflow.operators.windows import time_slice
from userflow.plans import registry
from userflow.sources.events import count_bad_lines, load_activity, write_activity
from userflow.sources.schema import DAY_MS, LOG_PAGES
from userflow.sources.tables import read_table


def _day(day, n, user="u"):
    return [event(f"{user}{i}", day * DAY_MS + i) for i in range(n)]


def test_days_are_added_and_replaced(spark, tmp_path):
    path = str(tmp_path / "log")
    write_activity(make_log(spark, _day(1, 5)), path)
    write_activity(make_log(spark, _day(2, 3)), path)
    assert load_activity(spark, path, "parquet").count() == 8
    write_activity(make_log(spark, _day(2, 4, "v")), path, mode="replace_days")
    rows = load_activity(spark, path, "parquet")
    assert {r["day"]: r["count"] for r in rows.groupBy("day").count().collect()} == {1: 5, 2: 4}
    write_activity(make_log(spark, _day(3, 1)), path, mode="replace_all")
    assert load_activity(spark, path, "parquet").count() == 1
    with pytest.raises(ValueError):
        write_activity(make_log(spark, _day(1, 1)), path, mode="error")


def test_a_days_files_are_bounded(spark, tmp_path):
    path = tmp_path / "log"
    write_activity(make_log(spark, _day(1, 200) + _day(2, 200)).repartition(16), str(path), files_per_day=2)
    assert 1 <= len(list((path / "day=1").glob("*.parquet"))) <= 2


def test_slices_prune_stored_days(spark, tmp_path):
    path = str(tmp_path / "log")
    write_activity(make_log(spark, _day(1, 5) + _day(2, 5) + _day(3, 5)), path)
    part = time_slice(load_activity(spark, path, "parquet"), 2 * DAY_MS, 3 * DAY_MS)
    plan = part._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):].split("PushedFilters")[0]
    assert "day" in filters and ">= 2" in filters and "<= 2" in filters
    assert part.count() == 5


def test_a_table_that_grew_is_read_whole(spark, tmp_path):
    spark.range(5).write.parquet(f"{tmp_path}/t.parquet")
    assert read_table(spark, str(tmp_path), "t").count() == 5
    spark.range(5).write.mode("append").parquet(f"{tmp_path}/t.parquet")
    assert read_table(spark, str(tmp_path), "t").count() == 10


GOOD = {"userId": "1", "ts": 1000, "page": "Home", "sessionId": 3, "itemInSession": 0, "level": "paid", "gender": "F"}


@pytest.mark.parametrize("bad", ['{"userId": "1", "ts": ', json.dumps({**GOOD, "ts": "noon"}),
                                 json.dumps({k if k != "ts" else "time": v for k, v in GOOD.items()})])
def test_bad_lines_fail_or_are_kept(spark, tmp_path, bad):
    p = tmp_path / "log.json"
    p.write_text(json.dumps(GOOD) + "\n" + bad + "\n")
    with pytest.raises(Exception):
        load_activity(spark, str(p)).collect()
    kept = load_activity(spark, str(p), bad_lines="keep")
    assert kept.count() == 2 and count_bad_lines(kept) == 1
    with pytest.raises(ValueError):
        load_activity(spark, str(p), bad_lines="drop")


def test_columnar_files_are_checked_before_the_schema_is_imposed(spark, tmp_path):
    spark.createDataFrame([("1", "noon")], "userId string, ts string").write.parquet(f"{tmp_path}/p")
    with pytest.raises(ValueError):
        load_activity(spark, f"{tmp_path}/p", "parquet")


def test_null_labels_are_kept_and_other_labels_refused(spark):
    rows = [(f"u{i}", None if i < 3 else 0 if i < 20 else 1) for i in range(120)]
    df = spark.createDataFrame(rows, "userId string, y int")
    out = rebalance(df, "y", 5)
    got = {r["y"]: r["n"] for r in out.groupBy("y").agg(F.count("*").alias("n")).collect()}
    assert got[None] == 3 and got[0] == 17 and 5 < got[1] < 40
    with pytest.raises(ValueError):
        rebalance_condition(spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "userId string, y int"), "y", 5)
    assert rebalance_condition(df.where("y is null"), "y", 5) is None


def test_a_cluster_must_name_its_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        session.shared_dir(Session())


def test_written_copies_are_released(spark):
    import os

    path = session.materialize(spark.range(3)).inputFiles()[0].removeprefix("file:")
    assert os.path.exists(path)
    session.release(spark)
    assert not os.path.exists(path)


def test_flags_tell_users_apart_on_the_test_tables(spark):
    log = registry.rare(spark, SF_SMALL, ["userId", "ts", "page"])
    flags = user_flags(log, registry.PAGES)
    for name in ("churn", "upgrade", "downgrade"):
        assert {r[0] for r in flags.select(name).distinct().collect()} == {"Yes", "No"}
    assert log.count() == read_table(spark, SF_SMALL, "events").count()


def test_tied_last_rows_count_each(spark):
    log = make_log(spark, [event("a", 1, "Cancellation Confirmation", level="free"), event("a", 5, level="paid"),
                           event("a", 5, level="paid"), event("a", 5, level="free"), event("b", 2, level="free")])
    got = {(r["level"], r["churn"]): r["n"] for r in last_level_by(log, LOG_PAGES).collect()}
    assert got == {("paid", "Yes"): 2, ("free", "Yes"): 1, ("free", "No"): 1}


@pytest.mark.parametrize("name", ["users_by_churn", "users_by_flag_combo", "gender_by_churn", "user_profile", "last_level_by_churn"])
def test_user_rows_are_hash_aggregated(spark, name):
    df = registry.SQL_QUERIES[name](spark, SF_SMALL)
    assert "SortAggregate" not in df._jdf.queryExecution().executedPlan().toString()


def test_adapter_reads_only_what_is_asked(spark):
    plan = registry.q_tenure_days(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "c_custkey" not in plan and plan.count("event_type") == 0 and "Window" not in plan
