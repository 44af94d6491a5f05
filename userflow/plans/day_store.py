"""Stored day partials: feature tables for new cutoffs without the raw log.

A store holds, for every user and calendar day (UTC), what the feature table
needs of that day: page counts, summed length, earliest registration, last level
and gender, label flags (table ``days``) and the top item of each session (table
``sessions``), both partitioned by day.  A new day's log is reduced once, on
arrival; a feature table for any cutoff plan then reads the partials of its days
only, which are far fewer and narrower than the events.

Partials of one day may be written in several batches (late rows): they merge in
the aggregates of the feature table.  :func:`compact` merges them for good.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from userflow.functions.columns import e, floor_div_sql
from userflow.operators.clean import drop_anonymous
from userflow.operators.features import day_partials, from_partials, session_days
from userflow.operators.windows import CutoffPlan
from userflow.session import materialize
from userflow.sources.events import FILES_PER_DAY
from userflow.sources.schema import DAY_MS, LABEL_CODES, PAGE_CODES, count_column

#: Columns of the two tables (both partitioned by ``day``, days since 1970).
TABLES = {
    "days": "userId string, " + ", ".join(f"{count_column(c)} long" for c, _ in PAGE_CODES)
            + ", _len decimal(28,6), _reg_min long, _reg_null int, _paid long, _fem long, "
            + ", ".join(f"_lab_{name} int" for name, _ in LABEL_CODES) + ", day long",
    "sessions": "userId string, sessionId long, _m long, _k long, day long",
}
_DAY_SQL = floor_div_sql("ts", DAY_MS)


def _write(df: DataFrame, path: str, mode: str, files_per_day: int) -> None:
    out = df.repartition("day", F.pmod(F.xxhash64("userId"), F.lit(int(files_per_day))))
    (out.write.mode("append" if mode == "append" else "overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("day").parquet(path))


def _read(spark: SparkSession, path: str, table: str) -> DataFrame:
    return spark.read.schema(TABLES[table]).parquet(f"{path}/{table}")


def store_days(log: DataFrame, path: str, pages: dict[str, str], mode: str = "append",
               files_per_day: int = FILES_PER_DAY) -> None:
    """Reduce ``log`` to day partials and add them to the store at ``path``.

    ``mode='append'`` adds the rows' partials to what the store holds;
    ``'replace_days'`` replaces the days that ``log`` holds (all their rows are in
    it) and leaves other days as they are.  Rows without a user are left out.  The
    two tables are written one after the other; after a failure between them the
    call is repeated with ``'replace_days'``.
    """
    if mode not in ("append", "replace_days"):
        raise ValueError(f"mode is 'append' or 'replace_days', not {mode!r}")
    known, day = drop_anonymous(log), e(_DAY_SQL, "day")
    _write(day_partials(known, day, pages), f"{path}/days", mode, files_per_day)
    _write(session_days(known, day, "day"), f"{path}/sessions", mode, files_per_day)


def compact(spark: SparkSession, path: str, first_day: int, last_day: int, files_per_day: int = FILES_PER_DAY) -> None:
    """Merge the partial rows of the days ``first_day .. last_day`` (days since
    1970) to one per user, day (and session), and rewrite those days."""
    days, sessions = (_read(spark, path, t).where(F.col("day").between(first_day, last_day)) for t in TABLES)
    merged = days.groupBy("userId", "day").agg(
        *[e(f"sum({count_column(c)})", count_column(c)) for c, _ in PAGE_CODES],
        e("cast(sum(_len) as decimal(28,6))", "_len"), e("min(_reg_min)", "_reg_min"), e("max(_reg_null)", "_reg_null"),
        e("max(_paid)", "_paid"), e("max(_fem)", "_fem"),
        *[e(f"max(_lab_{name})", f"_lab_{name}") for name, _ in LABEL_CODES])
    tops = sessions.groupBy("userId", "day", "sessionId", "_m").agg(e("sum(_k)", "_k"))
    tops = tops.groupBy("userId", "day", "sessionId").agg(e("max(_m)", "_top"), e("max_by(_k, _m)", "_k"))
    # Both are written before the store is touched: they read what they replace.
    merged, tops = materialize(merged), materialize(tops.withColumnRenamed("_top", "_m"))
    _write(merged, f"{path}/days", "replace_days", files_per_day)
    _write(tops, f"{path}/sessions", "replace_days", files_per_day)


def feature_table_from_days(spark: SparkSession, path: str, plan: CutoffPlan) -> DataFrame:
    """:func:`userflow.operators.features.feature_table` (``ties='one'``) of the
    stored days, from partials alone.

    Cutoffs must lie on UTC midnights, as the stored days do.  Only the days of
    the plan's windows are read (a partition filter); days that the store does
    not hold count as days without events.
    """
    if plan.cutoff_ms % DAY_MS:
        raise ValueError("the store holds whole UTC days: cutoffs must be UTC midnights")
    first = plan.cutoff_ms // DAY_MS
    within = F.col("day").between(plan.start_ms // DAY_MS, plan.end_ms // DAY_MS - 1)
    days, sessions = (_read(spark, path, t).where(within).withColumn("slot", F.col("day") - F.lit(first)).drop("day")
                      for t in TABLES)
    return from_partials(days, sessions, plan)
