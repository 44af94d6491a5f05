"""Per-user features over a look-back window and lifecycle labels over a
look-ahead window, for every cutoff offset at once.

Two forms with equal results:

* :func:`feature_table_literal` - the join form: behaviour counts, session
  depth, last state and labels computed separately per (user, offset) and
  left-joined, then ``fillna(0)``.  It supports ``ties='all'`` (one feature row
  per event tied at the last timestamp) and is the reference for equivalence
  tests.
* :func:`feature_table` - the production form.  Rows are first reduced to
  per-(user, day) partials (21 page counts, summed length, earliest
  registration, last level / gender, label flags) with map-side combine; the
  day partials are then fanned out to the offsets whose windows contain the
  day and summed.  Cutoffs and window edges are whole days from the first
  cutoff, so a day never straddles a window edge and the result is exact.
  Session depth needs, per session, the highest item number and how many
  rows hold it; that is built by aggregation too (item -> session-day ->
  session-window, at most look-back days per session) and joins the same
  final aggregate, so no user or session is ever sorted in one task.  Only
  day- or session-level partials are fanned out to offsets.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from userflow.functions.columns import (
    e,
    exact_length_sql,
    female_flag_sql,
    offset_id_sql,
    page_flag_sql,
    paid_flag_sql,
    q,
    tenure_days_sql,
)
from userflow.operators.clean import drop_anonymous
from userflow.operators.windows import CutoffPlan, cutoff_sql, expand_offsets, fan_out_days, slot_sql, time_slice
from userflow.sources.schema import (
    DAY_MS,
    LABEL_CODES,
    LABELS,
    PAGE_CODES,
    count_column,
    feature_columns,
)

KEY = ["userId", "offset_idx"]
FEATURES = feature_columns()


# --- join form ---------------------------------------------------------------

def windowed_rows(df: DataFrame, plan: CutoffPlan) -> DataFrame:
    """Clean rows repeated per offset window, with ``offset_idx``, ``cutoff_ms``, ``in_train``."""
    return expand_offsets(drop_anonymous(df), plan)


def behaviour(train: DataFrame, pages: dict[str, str]) -> DataFrame:
    """Per (user, offset): 21 page counts, total length, tenure in days."""
    return train.groupBy(*KEY).agg(
        e("max(cutoff_ms)", "cutoff_ms"),
        *[e(f"count_if(page = {q(pages[code])})", count_column(code)) for code, _ in PAGE_CODES],
        e(f"cast(sum({exact_length_sql('length')}) as double)", "total_length"),
        e(f"max({tenure_days_sql('registration', 'cutoff_ms')})", "tenure_days"),
    )


def session_last_items(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows at their session's highest item number (ties kept), sessions
    being (``keys``, sessionId); null sessionIds form one session."""
    top = rows.groupBy(*keys, "sessionId").agg(F.max("itemInSession").alias("_m"))
    top = top.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("sessionId").alias("_s"), "_m")
    cond = rows["sessionId"].eqNullSafe(top["_s"]) & (rows["itemInSession"] == top["_m"])
    for k in keys:
        cond = cond & (rows[k] == top[f"_{k}"])
    return rows.join(top, cond, "left_semi")


def session_depth(train: DataFrame) -> DataFrame:
    """Per (user, offset): mean item number over rows at a session's highest item."""
    return session_last_items(train, KEY).groupBy(*KEY).agg(F.avg("itemInSession").alias("avg_session_depth"))


def last_state(train: DataFrame, ties: str = "one") -> DataFrame:
    """Level and gender at the last event of each (user, offset).

    ``ties='one'``: one row, flag = 1 if any row at the last ts has it.
    ``ties='all'``: one row per row at the last ts.
    """
    last = train.groupBy(*KEY).agg(F.max("ts").alias("_t"))
    last = last.select(*[F.col(k).alias(f"_{k}") for k in KEY], "_t")
    cond = train["ts"] == last["_t"]
    for k in KEY:
        cond = cond & (train[k] == last[f"_{k}"])
    rows = train.join(last, cond, "left_semi").select(
        *KEY, e(paid_flag_sql("level"), "last_paid"), e(female_flag_sql("gender"), "last_female")
    )
    if ties == "all":
        return rows
    if ties != "one":
        raise ValueError("ties must be 'one' or 'all'")
    return rows.groupBy(*KEY).agg(F.max("last_paid").alias("last_paid"), F.max("last_female").alias("last_female"))


def lifecycle_labels(ahead: DataFrame, pages: dict[str, str]) -> DataFrame:
    """Per (user, offset) seen in the look-ahead window: 1 if the label event occurs."""
    return ahead.groupBy(*KEY).agg(
        *[e(f"max({page_flag_sql('page', pages[code])})", name) for name, code in LABEL_CODES]
    )


def _finish(df: DataFrame) -> DataFrame:
    """Offset-tagged id, fixed column order, numeric nulls -> 0."""
    out = df.fillna(0, subset=FEATURES + LABELS)
    return out.select(
        e(offset_id_sql("userId", "offset_idx"), "userId"),
        e("userId", "base_user"),
        "offset_idx",
        "cutoff_ms",
        *FEATURES,
        *[e(f"cast({c} as int)", c) for c in LABELS],
    )


def join_session_depth(rows: DataFrame, pages: dict[str, str]) -> DataFrame:
    train = rows.where("in_train")
    return behaviour(train, pages).join(session_depth(train), KEY, "left")


def join_last_state(rows: DataFrame, pages: dict[str, str], ties: str = "one") -> DataFrame:
    train = rows.where("in_train")
    return join_session_depth(rows, pages).join(last_state(train, ties), KEY, "left")


def join_labels(rows: DataFrame, pages: dict[str, str], ties: str = "one") -> DataFrame:
    ahead = rows.where(~F.col("in_train"))
    return join_last_state(rows, pages, ties).join(lifecycle_labels(ahead, pages), KEY, "left")


def feature_table_literal(df: DataFrame, plan: CutoffPlan, pages: dict[str, str], ties: str = "one") -> DataFrame:
    """Join form of the feature table (see module doc)."""
    return _finish(join_labels(windowed_rows(df, plan), pages, ties))


# --- production form ---------------------------------------------------------


def day_partials(log: DataFrame, day: Column, pages: dict[str, str]) -> DataFrame:
    """Branch A, step 1: one row per (user, day) with every mergeable partial;
    ``day`` is the named day column (relative to a cutoff, or of the calendar).

    Last level / gender are kept as ``max(2 * ts + flag)``: the max is reached
    at the latest ts and, among rows tied there, by the largest flag, which
    ``pmod(max, 2)`` returns.  A plain long keeps the aggregation hash-based
    (a struct max would force a sort-based one).
    """
    return log.groupBy("userId", day).agg(
        *[e(f"count_if(page = {q(pages[code])})", count_column(code)) for code, _ in PAGE_CODES],
        e(f"sum({exact_length_sql('length')})", "_len"),
        e("min(registration)", "_reg_min"),
        e("max(CASE WHEN registration IS NULL THEN 1 ELSE 0 END)", "_reg_null"),
        e(f"max(ts * 2L + {paid_flag_sql('level')})", "_paid"),
        e(f"max(ts * 2L + {female_flag_sql('gender')})", "_fem"),
        *[e(f"max({page_flag_sql('page', pages[code])})", f"_lab_{name}") for name, code in LABEL_CODES],
    )


def session_days(log: DataFrame, day: Column, name: str) -> DataFrame:
    """Branch B, step 1: per (user, day, session) its top item ``_m`` and the
    number ``_k`` of rows at it, through rows per (user, day, session, item).
    ``name`` is the name of the ``day`` column."""
    items = (
        log.where("itemInSession IS NOT NULL")
        .groupBy("userId", day, "sessionId", "itemInSession")
        .agg(e("count(1)", "_n"))
    )
    return items.groupBy("userId", name, "sessionId").agg(
        e("max(itemInSession)", "_m"), e("max_by(_n, itemInSession)", "_k")
    )


def session_windows(session_day: DataFrame, plan: CutoffPlan) -> DataFrame:
    """Branch B, step 2: per (user, offset, session) the depth contribution
    ``_dnum = top item * rows at it`` and ``_dden = rows at it``: over the days of a
    window (at most look-back days of them) the top item and the summed rows of
    the days that reach it.  A day may come in several partial rows."""
    per_session = fan_out_days(session_day, plan, with_labels=False).groupBy(*KEY, "sessionId").agg(
        e("collect_list(named_struct('m', _m, 'k', _k))", "_parts")
    )
    at_top = "aggregate(filter(_parts, x -> x.m = _top), 0L, (acc, x) -> acc + x.k)"
    return (
        per_session.select(*KEY, "_parts", e("array_max(transform(_parts, x -> x.m))", "_top"))
        .select(*KEY, e(f"_top * {at_top}", "_dnum"), e(at_top, "_dden"))
    )


def _session_parts(log: DataFrame, plan: CutoffPlan) -> DataFrame:
    return session_windows(session_days(log, e(slot_sql(plan), "slot"), "slot"), plan)


def _offset_rows(days_fanned: DataFrame, sessions: DataFrame, plan: CutoffPlan) -> DataFrame:
    """Day partials and session contributions summed per (user, offset) in one
    aggregate; offsets without a look-back row are dropped."""
    both = days_fanned.unionByName(sessions, allowMissingColumns=True)
    tr = "in_train"
    tenure = (f"greatest(({cutoff_sql(plan)} - _reg_min) / {float(DAY_MS)}D, "
              "CASE WHEN _reg_null = 1 THEN 0.0D END)")
    agg = both.groupBy(*KEY).agg(
        e(f"max(cast({tr} as int))", "_has_train"),
        *[e(f"sum(CASE WHEN {tr} THEN {count_column(c)} END)", count_column(c)) for c, _ in PAGE_CODES],
        e(f"cast(sum(CASE WHEN {tr} THEN _len END) as double)", "total_length"),
        e(f"max(CASE WHEN {tr} THEN {tenure} END)", "tenure_days"),
        e(f"cast(pmod(max(CASE WHEN {tr} THEN _paid END), 2) as int)", "last_paid"),
        e(f"cast(pmod(max(CASE WHEN {tr} THEN _fem END), 2) as int)", "last_female"),
        *[e(f"max(CASE WHEN NOT {tr} THEN _lab_{n} END)", n) for n in LABELS],
        e("cast(sum(_dnum) as double) / sum(_dden)", "avg_session_depth"),
    )
    return agg.where("_has_train = 1").select(
        *[c for c in agg.columns if c != "_has_train"], e(cutoff_sql(plan), "cutoff_ms")
    )


def behaviour_features(source, plan: CutoffPlan, pages: dict[str, str]) -> DataFrame:
    """Per (user, offset): 21 page counts, total length and tenure over the
    look-back windows, by the production path (day partials fanned out to
    offsets).  Same rows as :func:`behaviour` over :func:`windowed_rows`."""
    log = time_slice(drop_anonymous(_read(source, ["userId", "ts", "page", "registration", "length"])),
                     plan.start_ms, plan.cutoff_ms)
    days = log.groupBy("userId", e(slot_sql(plan), "slot")).agg(
        *[e(f"count_if(page = {q(pages[code])})", count_column(code)) for code, _ in PAGE_CODES],
        e(f"sum({exact_length_sql('length')})", "_len"),
        e("min(registration)", "_reg_min"),
        e("max(CASE WHEN registration IS NULL THEN 1 ELSE 0 END)", "_reg_null"),
    )
    tenure = (f"greatest(({cutoff_sql(plan)} - _reg_min) / {float(DAY_MS)}D, "
              "CASE WHEN _reg_null = 1 THEN 0.0D END)")
    return fan_out_days(days, plan, with_labels=False).groupBy(*KEY).agg(
        e(f"max({cutoff_sql(plan)})", "cutoff_ms"),
        *[e(f"sum({count_column(c)})", count_column(c)) for c, _ in PAGE_CODES],
        e("cast(sum(_len) as double)", "total_length"),
        e(f"max({tenure})", "tenure_days"),
    )


def session_depth_table(source, plan: CutoffPlan) -> DataFrame:
    """Per (user, offset): mean top item per session, by the aggregate-only
    path.  Same rows as :func:`session_depth` over the look-back windows."""
    rows = time_slice(drop_anonymous(_read(source, DEPTH_INPUT)), plan.start_ms, plan.cutoff_ms)
    return _session_parts(rows, plan).groupBy(*KEY).agg(
        e("cast(sum(_dnum) as double) / sum(_dden)", "avg_session_depth")
    )


def last_state_table(source, plan: CutoffPlan) -> DataFrame:
    """Per (user, offset): level and gender at the last look-back event
    (``ties='one'``), from per-day ``max(2 * ts + flag)`` partials."""
    log = time_slice(drop_anonymous(_read(source, ["userId", "ts", "level", "gender"])),
                     plan.start_ms, plan.cutoff_ms)
    days = log.groupBy("userId", e(slot_sql(plan), "slot")).agg(
        e(f"max(ts * 2L + {paid_flag_sql('level')})", "_paid"),
        e(f"max(ts * 2L + {female_flag_sql('gender')})", "_fem"),
    )
    return fan_out_days(days, plan, with_labels=False).groupBy(*KEY).agg(
        e("cast(pmod(max(_paid), 2) as int)", "last_paid"),
        e("cast(pmod(max(_fem), 2) as int)", "last_female"),
    )


def last_state_all_table(source, plan: CutoffPlan) -> DataFrame:
    """Per (user, offset): one row per event at the last look-back timestamp
    (``ties='all'``), without repeating raw rows per window.

    per (user, day, ts)  rows of each (paid, female) combination
    per (user, day)      the counts at the day's latest ts (exact: ts is a key)
    per (user, offset)   the counts of the latest day in the window (days never
                         share a ts), expanded back into that many rows
    """
    log = time_slice(drop_anonymous(_read(source, ["userId", "ts", "level", "gender"])),
                     plan.start_ms, plan.cutoff_ms)
    paid, fem = paid_flag_sql("level"), female_flag_sql("gender")
    combos = [(p_, f_) for p_ in (0, 1) for f_ in (0, 1)]
    at_ts = log.groupBy("userId", e(slot_sql(plan), "slot"), "ts").agg(
        *[e(f"count_if({paid} = {p_} AND {fem} = {f_})", f"n{p_}{f_}") for p_, f_ in combos]
    )
    counts = "named_struct(" + ", ".join(f"'n{p_}{f_}', n{p_}{f_}" for p_, f_ in combos) + ")"
    days = at_ts.groupBy("userId", "slot").agg(e("max(ts)", "_t"), e(f"max_by({counts}, ts)", "_c"))
    per = fan_out_days(days, plan, with_labels=False).groupBy(*KEY).agg(e("max_by(_c, _t)", "_c"))
    parts = ", ".join(
        f"array_repeat(named_struct('p', {p_}, 'f', {f_}), cast(_c.n{p_}{f_} AS int))" for p_, f_ in combos
    )
    return per.select(*KEY, e(f"explode(flatten(array({parts})))", "_s")).select(
        *KEY, e("_s.p", "last_paid"), e("_s.f", "last_female")
    )


def labels_table(source, plan: CutoffPlan, pages: dict[str, str]) -> DataFrame:
    """Per (user, offset) seen in the look-ahead window: the three labels,
    from per-day flags fanned out to the look-ahead windows."""
    log = time_slice(drop_anonymous(_read(source, ["userId", "ts", "page"])), plan.cutoff(plan.n_extra),
                     plan.end_ms)
    days = log.groupBy("userId", e(slot_sql(plan), "slot")).agg(
        *[e(f"max({page_flag_sql('page', pages[code])})", f"_lab_{name}") for name, code in LABEL_CODES]
    )
    ahead = fan_out_days(days, plan, with_labels=True).where("NOT in_train")
    return ahead.groupBy(*KEY).agg(*[e(f"max(_lab_{name})", name) for name in LABELS])


def joined_parts(source, plan: CutoffPlan, pages: dict[str, str], upto: str = "labels") -> DataFrame:
    """The reference's left joins on (user, offset) over the per-part tables:
    behaviour -> + session depth (``upto='depth'``) -> + last state
    (``'state'``) -> + labels (``'labels'``).  Every part is aggregated before
    it is joined, so the joins see one row per (user, offset) a side."""
    out = behaviour_features(source, plan, pages).join(session_depth_table(source, plan), KEY, "left")
    if upto == "depth":
        return out
    out = out.join(last_state_table(source, plan), KEY, "left")
    if upto == "state":
        return out
    return out.join(labels_table(source, plan, pages), KEY, "left")


BEHAVIOUR_INPUT = ["userId", "ts", "page", "level", "gender", "registration", "length"]
DEPTH_INPUT = ["userId", "ts", "sessionId", "itemInSession"]

Source = DataFrame | Callable[[list[str]], DataFrame]


def _read(source: Source, cols: list[str]) -> DataFrame:
    """The log with ``cols``; a callable source builds only those columns."""
    return source(cols) if callable(source) else source.select(*cols)


def drop_prior_churn(table: DataFrame, log: DataFrame, pages: dict[str, str], before_ms: int) -> DataFrame:
    """Remove (user, offset) rows of users whose churn event happened before
    that offset's cutoff (anywhere in the log, not only in the look-back).

    One aggregate per user (first churn time before ``before_ms``, the latest
    cutoff) and an anti join keyed on the user; the cutoff comparison is a
    residual condition of that join.
    """
    churn_page = pages[dict(LABEL_CODES)["churn"]]
    first = (
        drop_anonymous(log.select("userId", "ts", "page"))
        .where((F.col("page") == churn_page) & (F.col("ts") < F.lit(int(before_ms))))
        .groupBy(F.col("userId").alias("_u"))
        .agg(F.min("ts").alias("_first_churn"))
    )
    cond = (table["base_user"] == first["_u"]) & (first["_first_churn"] < table["cutoff_ms"])
    return table.join(first, cond, "left_anti")


def feature_table(source: Source, plan: CutoffPlan, pages: dict[str, str], ties: str = "one",
                  exclude_prior_churn: bool = False) -> DataFrame:
    """Feature and label table, one row per (user, offset) with a look-back row.

    ``source`` is the event log, or a function returning the log restricted
    to a list of columns (so derived columns are built only by the branch
    that needs them).  Columns: ``userId`` (``<user>_x<offset>``),
    ``base_user``, ``offset_idx``, ``cutoff_ms``, the 26 features in model
    order, ``upgrade``, ``downgrade``, ``churn``.  ``ties='all'`` keeps one
    row per event tied at the last timestamp and is served by the join form.
    """
    if exclude_prior_churn:
        table = feature_table(source, plan, pages, ties)
        return drop_prior_churn(table, _read(source, ["userId", "ts", "page"]), pages, plan.cutoff_ms)
    if ties == "all":
        one = feature_table(source, plan, pages, "one")
        tied = last_state_all_table(source, plan).select(
            F.col("userId").alias("_u"), F.col("offset_idx").alias("_o"), "last_paid", "last_female")
        rows = one.drop("last_paid", "last_female").join(
            tied, (F.col("base_user") == F.col("_u")) & (F.col("offset_idx") == F.col("_o")), "inner")
        return rows.select(*one.columns)
    if ties != "one":
        raise ValueError("ties must be 'one' or 'all'")
    log = time_slice(drop_anonymous(_read(source, BEHAVIOUR_INPUT)), plan.start_ms, plan.end_ms)
    rows = time_slice(drop_anonymous(_read(source, DEPTH_INPUT)), plan.start_ms, plan.cutoff_ms)
    slot = e(slot_sql(plan), "slot")
    return from_partials(day_partials(log, slot, pages), session_days(rows, slot, "slot"), plan)


def from_partials(days: DataFrame, sessions: DataFrame, plan: CutoffPlan) -> DataFrame:
    """The feature table from :func:`day_partials` and :func:`session_days` with
    the day as ``slot`` (relative to the first cutoff).  Days outside the windows
    are ignored; a day may come in several partial rows."""
    fanned = fan_out_days(days, plan, with_labels=True)
    return _finish(_offset_rows(fanned, session_windows(sessions, plan), plan))
