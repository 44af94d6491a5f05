"""Exploration queries over the activity log.

"Rows at a user's first / last timestamp" and "flags spread to all of a
user's rows" are written as an aggregate joined back on its key rather than
as a window over raw rows: the aggregate combines map-side, and the join
back is keyed on (user, ts), which spreads even a user holding a large share
of the log over many tasks; the per-user join is split by AQE when skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from userflow.functions.columns import day_bucket, e, floor_div, page_flag
from userflow.session import materialize
from userflow.sources.schema import label_pages


FLAG_NAMES = ("churn", "upgrade", "downgrade")


def _null_safe_on(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]], known: str | None = None):
    """Equal pairs, nulls equal too; column ``known`` has no nulls, so a layout by
    it serves the join."""
    cond = None
    for lc, rc in pairs:
        c = left[lc] == right[rc] if lc == known else left[lc].eqNullSafe(right[rc])
        cond = c if cond is None else cond & c
    return cond


def daily_counts(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Rows per UTC day; ``day`` = epoch seconds of midnight."""
    return (
        df.select(day_bucket(ts).alias("day"))
        .groupBy("day")
        .agg(F.count("day").alias("n_logs"))
        .orderBy("day")
    )


def daily_lifecycle(df: DataFrame, pages: dict[str, str], ts: str = "ts", page: str = "page") -> DataFrame:
    """Churn, downgrade and upgrade events per UTC day, in one pass."""
    lp = label_pages(pages)
    return (
        df.select(day_bucket(ts).alias("day"), F.col(page).alias("_p"))
        .groupBy("day")
        .agg(*[F.count_if(F.col("_p") == F.lit(lp[n])).alias(f"n_{n}") for n in ("churn", "downgrade", "upgrade")])
        .orderBy("day")
    )


def _flags(pages: dict[str, str], page: str = "page") -> list:
    """0 / 1 aggregates: numbers keep the aggregation hash-based."""
    lp = label_pages(pages)
    return [F.max(page_flag(page, lp[n])).alias(n) for n in FLAG_NAMES]


def _yes_no_names() -> list:
    return [F.when(F.col(n) == 1, F.lit("Yes")).otherwise(F.lit("No")).alias(n) for n in FLAG_NAMES]


def user_flags(df: DataFrame, pages: dict[str, str], user: str = "userId", page: str = "page") -> DataFrame:
    """Per user: ``Yes`` / ``No`` for ever having churned, upgraded, downgraded."""
    return df.groupBy(user).agg(*_flags(pages, page)).select(user, *_yes_no_names())


def with_lifecycle_flags(df: DataFrame, pages: dict[str, str], user: str = "userId", known_users: bool = False) -> DataFrame:
    """Every row with its user's three Yes / No lifecycle flags (``known_users``: no
    user is null)."""
    flags = user_flags(df, pages, user).withColumnRenamed(user, "_u")
    out = df.join(flags, _null_safe_on(df, flags, [(user, "_u")], user if known_users else None), "inner")
    return out.drop("_u")


def user_profile(df: DataFrame, pages: dict[str, str], user: str = "userId", ts: str = "ts") -> DataFrame:
    """One row per user: lifecycle flags and the latest gender, level and
    registration (the state at the user's last event).

    The two values of ``gender`` (F, M) and ``level`` (paid, free) are carried as
    numbers behind the time; of tied last events F and paid win; any other value
    is null.  The latest registration is the largest of tied ones."""

    def latest(column: str, values: tuple[str, str]):
        code = F.when(F.col(column) == values[0], 2).when(F.col(column) == values[1], 1).otherwise(0)
        return F.max(F.col(ts) * 4 + code).alias(f"_{column}")

    def value(column: str, values: tuple[str, str]):
        code = F.pmod(F.col(f"_{column}"), F.lit(4))
        return F.when(code == 2, F.lit(values[0])).when(code == 1, F.lit(values[1])).alias(column)

    gender, level = ("F", "M"), ("paid", "free")
    per_user = df.groupBy(user).agg(*_flags(pages), latest("gender", gender), latest("level", level),
                                    F.max_by("registration", ts).alias("registration"))
    return per_user.select(user, *_yes_no_names(), value("gender", gender), value("level", level), "registration")


def count_users_by(users: DataFrame, *cols: str) -> DataFrame:
    """Users per value combination of ``cols`` (input: one row per user)."""
    return users.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_users"))


def _rows_at(df: DataFrame, agg, user: str, ts: str, known_users: bool) -> DataFrame:
    edge = df.groupBy(user).agg(agg(ts).alias("_t")).withColumnRenamed(user, "_u")
    on = _null_safe_on(df, edge, [(user, "_u"), (ts, "_t")], user if known_users else None)
    return df.join(edge, on, "left_semi")


def first_events(df: DataFrame, user: str = "userId", ts: str = "ts", known_users: bool = False) -> DataFrame:
    """Rows at each user's first timestamp (ties kept; ``known_users``: no user is null)."""
    return _rows_at(df, F.min, user, ts, known_users)


def last_events(df: DataFrame, user: str = "userId", ts: str = "ts", known_users: bool = False) -> DataFrame:
    """Rows at each user's last timestamp (ties kept; ``known_users``: no user is null)."""
    return _rows_at(df, F.max, user, ts, known_users)


def entry_level(df: DataFrame, user: str = "userId", ts: str = "ts") -> DataFrame:
    """Count of first-event rows per level (a tie at the first ts counts each row)."""
    return first_events(df.select(user, ts, "level"), user, ts).groupBy("level").agg(F.count("level").alias("n"))


def last_level_by(df: DataFrame, pages: dict[str, str], flag: str = "churn", user: str = "userId",
                  ts: str = "ts") -> DataFrame:
    """Last-event rows per (level, lifecycle flag).

    The log is counted once by (user, time, level) with its flags; the user rows
    (last time, flags) and the counts at the last time both come from there."""
    counted = df.groupBy(user, ts, "level").agg(F.count(F.lit(1)).alias("_n"), *_flags(pages))
    users = counted.groupBy(F.col(user).alias("_u")).agg(
        F.max(ts).alias("_t"), F.max(flag).alias("_flag"))
    last = counted.select(user, ts, "level", "_n").join(
        users, F.col(user).eqNullSafe(F.col("_u")) & (F.col(ts) == F.col("_t")))
    named = F.when(F.col("_flag") == 1, F.lit("Yes")).otherwise(F.lit("No")).alias(flag)
    return last.select("level", named, "_n").groupBy("level", flag).agg(F.sum("_n").alias("n"))


def page_frequency(df: DataFrame, limit: int | None = None, page: str = "page") -> DataFrame:
    """Rows per page, most frequent first; ``limit`` keeps the top pages."""
    out = df.groupBy(page).agg(F.count(page).alias("n")).orderBy(F.desc("n"), F.asc_nulls_last(page))
    return out.limit(limit) if limit is not None else out


def occurrences(df: DataFrame, page_name: str, limit: int | None = None, user: str = "userId",
                ts: str = "ts") -> DataFrame:
    """(user, ts) of one page's occurrences, newest first."""
    out = df.where(F.col("page") == F.lit(page_name)).select(user, ts).orderBy(F.desc(ts), F.asc(user))
    return out.limit(limit) if limit is not None else out


QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)


def value_counts(df: DataFrame, group: str, value: str) -> DataFrame:
    """(group, value, _n): how often each value occurs, pre-aggregated in every
    task, written once: ranks, totals and other statistics all come from it."""
    return materialize(df.groupBy(group, value).agg(F.count(F.lit(1)).alias("_n")))


def exact_percentiles(df: DataFrame, group: str, value: str, qs=QUANTILES, split_width: int = 86_400_000) -> DataFrame:
    """Per ``group``: exact percentiles of ``value`` with linear interpolation
    (the semantics of Spark's ``percentile``), one column ``p<q*100>`` each.

    ``percentile`` keeps every distinct value of a group in one task's map; here
    see :func:`percentiles_of_counts`."""
    return percentiles_of_counts(value_counts(df.select(group, value), group, value), group, value, qs, split_width)


def percentiles_of_counts(counts: DataFrame, group: str, value: str, qs=QUANTILES,
                          split_width: int = 86_400_000) -> DataFrame:
    """:func:`exact_percentiles` from the value counts.

    Equal values are one row.  Running sums are taken inside ranges of
    ``split_width`` of the value, and over the sums of those ranges, so no task
    holds all values of a group; the two values around each percentile are then
    found in one join by their rank ranges."""
    rows = counts.where(F.col(value).isNotNull()).select(
        group, F.col(value).alias("_value"), "_n", floor_div(value, split_width).alias("_split"))
    ranges = rows.groupBy(group, "_split").agg(F.sum("_n").alias("_rn"))
    before = F.sum("_rn").over(Window.partitionBy(group).orderBy("_split")) - F.col("_rn")
    ranges = ranges.select(F.col(group).alias("_g"), F.col("_split").alias("_s"), before.alias("_before"))
    inside = F.sum("_n").over(Window.partitionBy(group, "_split").orderBy("_value")) - F.col("_n")
    ranked = (rows.withColumn("_inside", inside)
              .join(ranges, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_split") == F.col("_s")))
              .select(group, "_value", (F.col("_before") + F.col("_inside")).alias("_from"), "_n"))
    structs = ", ".join(f"named_struct('q', {float(x)}D, 'p', {float(x)}D * (_cnt - 1))" for x in qs)
    targets = (
        rows.groupBy(group).agg(F.sum("_n").alias("_cnt"))
        .select(F.col(group).alias("_g"), e(f"explode(array({structs}))", "_t"))
        .select("_g", e("_t.q", "_q"), e("_t.p", "_p"), e("cast(floor(_t.p) as bigint)", "_lo"),
                e("cast(ceil(_t.p) as bigint)", "_hi"))
    )

    def holds(at: str):
        return (F.col(at) >= F.col("_from")) & (F.col(at) < F.col("_from") + F.col("_n"))

    number = F.col("_value").cast("double")
    found = (
        ranked.join(targets, F.col(group).eqNullSafe(F.col("_g")) & (holds("_lo") | holds("_hi")))
        .groupBy("_g", "_q", "_p", "_lo", "_hi")
        .agg(F.max(F.when(holds("_lo"), number)).alias("_lv"), F.max(F.when(holds("_hi"), number)).alias("_hv"))
        .select("_g", "_q", e("CASE WHEN _hi = _lo OR _hv = _lv THEN _lv "
                              "ELSE (_hi - _p) * _lv + (_p - _lo) * _hv END", "_v"))
    )
    return found.groupBy(F.col("_g").alias(group)).agg(
        *[e(f"max(CASE WHEN _q = {float(x)}D THEN _v END)", f"p{int(round(x * 100)):02d}") for x in qs]
    )


def registration_spread(users: DataFrame, flag: str = "churn", registration: str = "registration") -> DataFrame:
    """Distribution of registration (in days since epoch) per flag value:
    exact percentiles (linear interpolation), min, max, mean."""
    day = F.col(registration) / F.lit(86_400_000.0)
    counts = value_counts(users.select(flag, registration), flag, registration)
    known = F.when(F.col(registration).isNotNull(), F.col("_n")).otherwise(F.lit(0))
    stats = counts.groupBy(flag).agg(
        F.sum(known).alias("n_users"),
        F.min(day).alias("min_day"),
        F.max(day).alias("max_day"),
        (F.sum(day * F.col("_n")) / F.when(F.sum(known) > 0, F.sum(known))).alias("avg_day"),
    )
    pct = percentiles_of_counts(counts, flag, registration).withColumnRenamed(flag, "_f")
    pcols = [f"p{int(round(x * 100)):02d}" for x in QUANTILES]
    out = stats.join(pct, stats[flag].eqNullSafe(pct["_f"]), "left")
    return out.select(
        flag, "n_users",
        *[(F.col(c) / F.lit(86_400_000.0)).alias(f"{c}_day") for c in pcols],
        "min_day", "max_day", "avg_day",
    )
