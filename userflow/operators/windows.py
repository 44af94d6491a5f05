"""Time windows: half-open slices, cutoff tables, offset planning and the
expansion of log rows onto the cutoff windows that contain them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from userflow.functions.columns import ceil_div_sql, e, floor_div, floor_div_sql, offset_id_sql
from userflow.sources.schema import DAY_MS


@dataclass(frozen=True)
class CutoffPlan:
    """Cutoffs ``cutoff_ms - interval_days * DAY * i`` for ``i = 0..n_extra``.

    Offset ``i`` uses the look-back window ``[c_i - look_back, c_i)`` for
    features and the look-ahead window ``[c_i, c_i + look_ahead)`` for labels.
    """

    cutoff_ms: int
    look_back_days: int
    look_ahead_days: int
    n_extra: int = 0
    interval_days: int = 1

    def __post_init__(self):
        if self.look_back_days <= 0 or self.look_ahead_days <= 0 or self.interval_days <= 0 or self.n_extra < 0:
            raise ValueError("look-back, look-ahead and interval must be positive, n_extra >= 0")

    @property
    def step_ms(self) -> int:
        return self.interval_days * DAY_MS

    @property
    def back_ms(self) -> int:
        return self.look_back_days * DAY_MS

    @property
    def ahead_ms(self) -> int:
        return self.look_ahead_days * DAY_MS

    def cutoff(self, i: int) -> int:
        return self.cutoff_ms - self.step_ms * i

    @property
    def start_ms(self) -> int:
        """Earliest timestamp any window reads."""
        return self.cutoff(self.n_extra) - self.back_ms

    @property
    def end_ms(self) -> int:
        """Exclusive end of the latest window."""
        return self.cutoff_ms + self.ahead_ms


def time_slice(df: DataFrame, start_ms: int, end_ms: int, ts: str = "ts") -> DataFrame:
    """Rows with ``start_ms <= ts < end_ms``; on the raw column so parquet
    readers receive the predicate.  Where the log is stored by ``day``, the days
    are bounded too, so other days' files are not opened."""
    out = df.where((F.col(ts) >= F.lit(int(start_ms))) & (F.col(ts) < F.lit(int(end_ms))))
    if "day" in df.columns:
        out = out.where(F.col("day").between(int(start_ms) // DAY_MS, (int(end_ms) - 1) // DAY_MS))
    return out


def cutoff_table(spark: SparkSession, plan: CutoffPlan) -> DataFrame:
    """(offset_idx, cutoff_ms, train_start_ms, label_end_ms), one row per offset."""
    i = F.col("id")
    c = F.lit(plan.cutoff_ms) - F.lit(plan.step_ms) * i
    return spark.range(plan.n_extra + 1).select(
        i.alias("offset_idx"),
        c.alias("cutoff_ms"),
        (c - F.lit(plan.back_ms)).alias("train_start_ms"),
        (c + F.lit(plan.ahead_ms)).alias("label_end_ms"),
    )


def offsets_sql(ts: str, plan: CutoffPlan, train_only: bool = False) -> tuple[str, str]:
    """(first, last) offset index whose window contains ``ts``; empty when first > last.

    Offset i contains ts when c_i - back <= ts < c_i + ahead (or < c_i for
    ``train_only``), i.e. ceil((C - back - ts) / step) <= i <= floor((C + ahead - ts - 1) / step).
    """
    end = 0 if train_only else plan.ahead_ms
    lo = f"greatest(0L, {ceil_div_sql(f'{plan.cutoff_ms - plan.back_ms}L - {ts}', plan.step_ms)})"
    hi = f"least({plan.n_extra}L, {floor_div_sql(f'{plan.cutoff_ms + end - 1}L - {ts}', plan.step_ms)})"
    return lo, hi


def expand_offsets(df: DataFrame, plan: CutoffPlan, ts: str = "ts", train_only: bool = False) -> DataFrame:
    """Each row once per offset window containing it, with ``offset_idx``,
    ``cutoff_ms`` and ``in_train``.

    A generator, not a join: the offsets of a row follow from its ``ts`` by
    integer arithmetic, so no table is broadcast and nothing is compared
    pairwise.  A row is repeated at most ``(back + ahead) / step + 1`` times.
    """
    lo, hi = offsets_sql(ts, plan, train_only)
    stop = plan.cutoff_ms if train_only else plan.end_ms
    within = time_slice(df, plan.start_ms, stop, ts)
    cutoff = f"{plan.cutoff_ms}L - {plan.step_ms}L * offset_idx"
    return (
        within.where(e(f"{lo} <= {hi}"))
        .select("*", e(f"explode(sequence({lo}, {hi}))", "offset_idx"))
        .select("*", e(cutoff, "cutoff_ms"))
        .select("*", e(f"{ts} < cutoff_ms", "in_train"))
    )


def slot_sql(plan: CutoffPlan, ts: str = "ts") -> str:
    """Day index relative to the first cutoff: day d covers [C + d*DAY, C + (d+1)*DAY).
    Window edges are whole days from C, so no day straddles an edge."""
    return floor_div_sql(f"{ts} - {plan.cutoff_ms}L", DAY_MS)


def cutoff_sql(plan: CutoffPlan, offset: str = "offset_idx") -> str:
    return f"({plan.cutoff_ms}L - {plan.step_ms}L * {offset})"


def fan_out_days(df: DataFrame, plan: CutoffPlan, with_labels: bool) -> DataFrame:
    """Repeat per-day rows (column ``slot``) for each offset whose window holds
    the day, with ``offset_idx`` and ``in_train``.

    Day d is in the look-back window of offset i when
    -(i*I + b) <= d <= -(i*I) - 1 and in its look-ahead window when
    -(i*I) <= d <= -(i*I) + l - 1 (I interval, b look-back, l look-ahead days).
    """
    step, b, l = plan.interval_days, plan.look_back_days, plan.look_ahead_days
    last = (l - 1) if with_labels else -1
    lo = f"greatest(0L, {ceil_div_sql(f'-slot - {b}L', step)})"
    hi = f"least({plan.n_extra}L, {floor_div_sql(f'{last}L - slot', step)})"
    return (
        df.where(e(f"{lo} <= {hi}"))
        .select("*", e(f"explode(sequence({lo}, {hi}))", "offset_idx"))
        .select("*", e(f"slot <= -offset_idx * {step}L - 1L", "in_train"))
    )


def day_rows(df: DataFrame, plan: CutoffPlan, user: str = "userId", ts: str = "ts") -> DataFrame:
    """Rows per (user, day) within the plan's range."""
    within = time_slice(df, plan.start_ms, plan.end_ms, ts)
    return within.groupBy(user, e(slot_sql(plan, ts), "slot")).agg(e("count(1)", "_rows"))


def offset_users(df: DataFrame, plan: CutoffPlan, user: str = "userId", ts: str = "ts") -> DataFrame:
    """Distinct (user, offset) pairs with look-back rows, and the offset-tagged id.

    Rows are first reduced to (user, day); only those are fanned out."""
    days = day_rows(df.select(user, ts), plan, user, ts)
    pairs = fan_out_days(days, plan, with_labels=False).select(user, "offset_idx").distinct()
    return pairs.select("*", e(offset_id_sql(user, "offset_idx"), "offset_user"))


def window_coverage(df: DataFrame, plan: CutoffPlan, user: str = "userId", ts: str = "ts") -> DataFrame:
    """Per offset: the cutoff table plus look-back rows, look-ahead rows and
    users with look-back rows, from per-(user, day) row counts."""
    fanned = fan_out_days(day_rows(df.select(user, ts), plan, user, ts), plan, with_labels=True)
    cover = fanned.groupBy("offset_idx").agg(
        e("coalesce(sum(CASE WHEN in_train THEN _rows END), 0L)", "n_train_rows"),
        e("coalesce(sum(CASE WHEN NOT in_train THEN _rows END), 0L)", "n_label_rows"),
        e(f"count(DISTINCT CASE WHEN in_train THEN {user} END)", "n_users"),
    )
    return cutoff_table(df.sparkSession, plan).join(cover, "offset_idx", "left")


def plan_offsets(df: DataFrame, look_back_days: int, look_ahead_days: int, interval_days: int,
                 n_buckets: int = 1, ts: str = "ts") -> DataFrame:
    """How many extra offsets fit in the log's history.

    History is measured in whole UTC days from the first to the last event.
    The latest cutoff lets the look-ahead window end with the last day; the
    number of extra offsets is ``(days - ahead - n_buckets * back) // interval``
    (negative -> none fit).
    """
    s = df.agg(F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"))
    first_day = floor_div("min_ts", DAY_MS)
    last_day = floor_div("max_ts", DAY_MS)
    days = last_day - first_day + F.lit(1)
    n_extra = F.floor((days - F.lit(look_ahead_days + n_buckets * look_back_days)) / F.lit(interval_days)).cast("long")
    cutoff = (last_day + F.lit(1 - look_ahead_days)) * F.lit(DAY_MS)
    return s.select(
        "min_ts",
        "max_ts",
        days.alias("history_days"),
        cutoff.alias("cutoff_ms"),
        n_extra.alias("n_extra"),
        (cutoff - F.greatest(n_extra, F.lit(0)) * F.lit(interval_days * DAY_MS)).alias("earliest_cutoff_ms"),
    )
