"""Activity view over the driver's test tables.

``events`` (event_id, ts, user_id, event_type, value), ``customer`` and
``orders`` are mapped onto :data:`EVENTS`:

* ``userId``        = user_id as string
* ``ts``            = epoch ms of ts
* ``page``          = event_type
* ``sessionId``     = UTC day number (one session per user and day)
* ``itemInSession`` = position in the session from 0, order (ts, event_id)
* ``level``         = ``paid`` when value >= 50, else ``free``
* ``gender``        = ``F`` when the customer key is even, else ``M``
* ``registration``  = first order date of the customer, epoch ms
* ``length``        = value for ``view`` events, else null

Only the requested columns are built: the customer join, the orders
aggregate and the in-session position cost a shuffle each and are skipped
when no consumer needs them.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from userflow.functions.columns import e, epoch_ms, floor_div, q
from userflow.operators.ordering import position_in_group
from userflow.sources.schema import DAY_MS, EVENT_COLUMNS, label_pages

VIEW_PAGE = "view"


def _ntz_literal(ms: int):
    t = _dt.datetime(1970, 1, 1) + _dt.timedelta(milliseconds=int(ms))
    return F.expr(f"TIMESTAMP_NTZ'{t.isoformat(sep=' ')}'")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table; its files are listed at every call, so rows added
    since the last one are read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def activity_from_tables(
    spark: SparkSession,
    sf_dir: str,
    columns: list[str] | None = None,
    between: tuple[int, int] | None = None,
    known_users: bool = False,
) -> DataFrame:
    """The activity log of the test tables, with only ``columns`` (default all).

    ``between = (start_ms, end_ms)`` keeps whole UTC days on the raw ``ts``,
    before anything else, so the filter reaches the parquet reader; sessions
    are whole days, so in-session positions are unchanged by it.

    ``known_users`` keeps only rows with a user id, at the source (callers
    that drop anonymous users anyway).
    """
    cols = list(columns) if columns else list(EVENT_COLUMNS)
    tz = spark.conf.get("spark.sql.session.timeZone")
    unknown = set(cols) - set(EVENT_COLUMNS)
    if unknown:
        raise ValueError(f"unknown columns {sorted(unknown)}")
    ev = read_table(spark, sf_dir, "events")
    if between is not None:
        start, end = between
        if start % DAY_MS or end % DAY_MS:
            raise ValueError("between must cover whole UTC days")
        ev = ev.where((F.col("ts") >= _ntz_literal(start)) & (F.col("ts") < _ntz_literal(end)))
    if known_users:  # the anonymous-user rule of the cleaning step, on the raw column
        ev = ev.where(F.col("user_id").isNotNull() & (F.col("user_id").cast("string") != F.lit("")))

    need = set(cols)
    base = [F.col("user_id")]
    ts_ms = epoch_ms("ts", tz)
    if need & {"ts", "sessionId", "itemInSession"}:
        base.append(ts_ms.alias("_ts"))
    if "itemInSession" in need:
        base.append(F.col("event_id"))
    if need & {"page", "length"}:
        base.append(F.col("event_type").alias("_page"))
    if need & {"level", "length"}:
        base.append(F.col("value"))
    df = ev.select(*base)
    if need & {"sessionId", "itemInSession"}:
        df = df.select("*", floor_div("_ts", DAY_MS).alias("_day"))
    if "itemInSession" in need:
        df = position_in_group(df, ["user_id", "_day"], ["_ts", "event_id"], "_item",
                               split=floor_div("_ts", 60_000))
    if "gender" in need:
        cust = read_table(spark, sf_dir, "customer").select("c_custkey")
        df = df.join(cust, df["user_id"] == cust["c_custkey"], "left")
    if "registration" in need:
        reg = (
            read_table(spark, sf_dir, "orders")
            .groupBy("o_custkey")
            .agg(F.min("o_orderdate").alias("_reg"))
        )
        df = df.join(reg, df["user_id"] == reg["o_custkey"], "left")

    exprs = {
        "userId": "cast(user_id as string)",
        "ts": "_ts",
        "page": "_page",
        "sessionId": "_day",
        "itemInSession": "_item",
        "level": "CASE WHEN value >= 50 THEN 'paid' ELSE 'free' END",
        "gender": "CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END",
        "registration": None,
        "length": f"CASE WHEN _page = {q(VIEW_PAGE)} THEN value END",
    }
    out = [epoch_ms("_reg", tz).alias(c) if c == "registration" else e(exprs[c], c) for c in cols]
    return df.select(*out)


def with_anonymous_users(df: DataFrame, empty_every: int = 50, null_every: int = 50,
                         no_registration_every: int = 7) -> DataFrame:
    """Fixture over the test tables, which have no anonymous users: a user id
    divisible by ``empty_every`` becomes ``''``, one with remainder 1 by
    ``null_every`` becomes null, and registration is removed for ids divisible
    by ``no_registration_every``.  Every row is kept."""
    k = F.col("_k")
    out = df.withColumn("_k", F.col("userId").try_cast("long")).withColumn(
        "userId",
        F.when(k % empty_every == 0, F.lit(""))
        .when(k % null_every == 1, F.lit(None).cast("string"))
        .otherwise(F.col("userId")),
    )
    if "registration" in df.columns:
        out = out.withColumn(
            "registration",
            F.when(k % no_registration_every == 0, F.lit(None).cast("long")).otherwise(F.col("registration")),
        )
    return out.drop("_k")


#: Of label-page events only those in every 17th second stay label events.
RARE_EVERY = 17
RARE_PAGE = "minor"


def with_rare_labels(df: DataFrame, pages: dict[str, str]) -> DataFrame:
    """Fixture over the test tables, where every user has every event type: a
    label page stays only where the second of ``ts`` is divisible by
    :data:`RARE_EVERY`, elsewhere it becomes :data:`RARE_PAGE`, so that each
    lifecycle flag holds for some users and not for others.  Every row is kept."""
    rare = F.col("page").isin(list(label_pages(pages).values())) & (F.expr(f"pmod(ts div 1000, {RARE_EVERY})") != 0)
    return df.withColumn("page", F.when(rare, F.lit(RARE_PAGE)).otherwise(F.col("page")))


def with_tied_times(df: DataFrame, grain_ms: int = 12 * 3_600_000) -> DataFrame:
    """Fixture: times cut down to half days, so first and last events tie."""
    return df.withColumn("ts", F.expr(f"ts - pmod(ts, {int(grain_ms)})"))
