"""Registered queries over the driver's test tables and their SQL twins.

Each key maps to a callable ``(spark, sf_dir) -> DataFrame`` and, where SQL
can express it, to an equivalent DuckDB statement over the raw tables.  Both
sides read whole tables.  Doubles are rounded to 6 places on both sides and
every output column is named the same.

Run setting (test tables): first cutoff 2024-01-28 UTC, look-back 14 days,
look-ahead 1 day, 6 extra cutoffs 1 day apart.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from userflow.functions.columns import length_filled, page_flag, round_doubles, tenure_days
from userflow.operators import clean, explore, features, importance, sampling, windows
from userflow.operators.evaluate import metrics
from userflow.sources.schema import DAY_MS, FEATURE_ORDER, LABELS, PAGE_CODES, TABLE_PAGES, count_column, label_pages
from userflow.plans import day_store
from userflow.session import materialize, shared_path
from userflow.sources import user_buckets
from userflow.sources.tables import (
    RARE_EVERY,
    RARE_PAGE,
    activity_from_tables,
    read_table,
    with_anonymous_users,
    with_rare_labels,
    with_tied_times,
)

PAGES = TABLE_PAGES
PLAN = windows.CutoffPlan(cutoff_ms=1_706_400_000_000, look_back_days=14, look_ahead_days=1, n_extra=6,
                          interval_days=1)
EXCLUDED = ["7"]
SPLIT_RATIO, SPLIT_SEED, REBALANCE_SEED = 0.7, 27, 271
LABEL = "churn"
CHURN_PAGE = PAGES["CC"]
RULE_MIN_CC = 5  # rule-based prediction for metric queries: churn when cnt_cc >= 5

FEATURES = features.FEATURES
DOUBLE_FEATURES = ["total_length", "tenure_days", "avg_session_depth"]


# --- Spark side -------------------------------------------------------------

def act(spark, sf, cols=None, between=None, known_users=False) -> DataFrame:
    return activity_from_tables(spark, sf, cols, between, known_users)


def anon(spark, sf, cols=None) -> DataFrame:
    return with_anonymous_users(act(spark, sf, cols))


def rare(spark, sf, cols) -> DataFrame:
    """The log in which lifecycle events are rare enough to tell users apart."""
    return with_rare_labels(act(spark, sf, cols), PAGES)


def plan_days(plan: windows.CutoffPlan):
    """Whole UTC days covering every window of ``plan`` (None if not whole days)."""
    if plan.start_ms % DAY_MS or plan.end_ms % DAY_MS:
        return None
    return plan.start_ms, plan.end_ms


def _source(spark, sf):
    """Column-aware view of the known users' activity over the plan's days."""
    return lambda cols: act(spark, sf, cols, plan_days(PLAN), True)


def _ft(spark, sf) -> DataFrame:
    return features.feature_table(_source(spark, sf), PLAN, PAGES)


def _split(spark, sf, ft=None):
    return sampling.split_by_key(ft if ft is not None else _ft(spark, sf), SPLIT_RATIO, SPLIT_SEED, key="user")


def _rebalanced(spark, sf, ft=None):
    train, _ = _split(spark, sf, ft)
    return sampling.rebalance(train, LABEL, REBALANCE_SEED, key="userId")


def _ft_written(spark, sf):
    """Feature table written once to the shared folder, for queries that read
    it more than once (class counts, then the rows; several sets; fit then
    transform)."""
    return materialize(_ft(spark, sf))


def _with_rule(df):
    return df.withColumn("prediction", F.when(F.col("cnt_cc") >= RULE_MIN_CC, 1.0).otherwise(0.0))


def _users_slice(spark, sf):
    return explore.user_profile(rare(spark, sf, ["userId", "ts", "page", "gender", "level", "registration"]), PAGES)


def q_activity_scan(spark, sf):
    return act(spark, sf)


def q_column_null_profile(spark, sf):
    return clean.null_profile(anon(spark, sf))


def q_clean_anonymous(spark, sf):
    return clean.drop_anonymous(anon(spark, sf))


def q_clean_excluded_users(spark, sf):
    return clean.exclude_users(anon(spark, sf), EXCLUDED)


def q_users_missing_registration(spark, sf):
    # Dropping anonymous rows filters on the id only, so "after" is "before"
    # without the anonymous ids: one distinct pass over the log, each user row
    # tagged with the stages it is in.
    users = clean.missing_registration(anon(spark, sf, ["userId", "registration"]))
    known = F.col("userId").isNotNull() & (F.col("userId") != F.lit(""))
    stages = F.when(known, F.array(F.lit("before"), F.lit("after"))).otherwise(F.array(F.lit("before")))
    return users.select(F.explode(stages).alias("stage"), "userId")


def q_event_occurrences(spark, sf):
    return explore.occurrences(act(spark, sf, ["userId", "ts", "page"]), CHURN_PAGE)


def q_window_slice(spark, sf):
    start, end = PLAN.cutoff_ms - PLAN.back_ms, PLAN.cutoff_ms
    return windows.time_slice(act(spark, sf, between=(start, end)), start, end)


def _train_ids(spark, sf):
    """Distinct users on the train side of the seeded split: the id list the
    reference collected; here it stays a DataFrame."""
    users = act(spark, sf, ["userId"]).select("userId").distinct()
    return users.where(sampling.split_condition("userId", SPLIT_RATIO, SPLIT_SEED))


def q_split_members(spark, sf):
    return sampling.split_by_ids(act(spark, sf), _train_ids(spark, sf))[0]


def q_split_non_members(spark, sf):
    return sampling.split_by_ids(act(spark, sf), _train_ids(spark, sf))[1]


def q_page_flags(spark, sf):
    a = act(spark, sf, ["userId", "ts", "page"])
    return a.select("userId", "ts", *[page_flag("page", PAGES[c]).alias(f"is_{c.lower()}") for c, _ in PAGE_CODES])


def q_tenure_days(spark, sf):
    a = anon(spark, sf, ["userId", "ts", "registration"])
    return round_doubles(a.select("userId", "ts", tenure_days("registration", PLAN.cutoff_ms).alias("tenure_days")))


def q_length_filled(spark, sf):
    a = act(spark, sf, ["userId", "ts", "length"])
    return a.select("userId", "ts", length_filled("length").alias("length_filled"))


def q_offset_ids(spark, sf):
    return windows.offset_users(clean.drop_anonymous(act(spark, sf, ["userId", "ts"])), PLAN)


def q_daily_log_count(spark, sf):
    return explore.daily_counts(act(spark, sf, ["ts"]))


def q_daily_lifecycle_counts(spark, sf):
    return explore.daily_lifecycle(act(spark, sf, ["ts", "page"]), PAGES)


def q_user_lifecycle_flags(spark, sf):
    return explore.with_lifecycle_flags(rare(spark, sf, ["userId", "ts", "page"]), PAGES)


def _by_flag(flag):
    def q(spark, sf):
        flags = explore.user_flags(rare(spark, sf, ["userId", "ts", "page"]), PAGES)
        return explore.count_users_by(flags, flag).orderBy(F.desc(flag))
    return q


def q_users_by_flag_combo(spark, sf):
    flags = explore.user_flags(rare(spark, sf, ["userId", "ts", "page"]), PAGES)
    return explore.count_users_by(flags, "churn", "upgrade", "downgrade").orderBy(F.desc("n_users"))


def q_page_frequency(spark, sf):
    return explore.page_frequency(act(spark, sf, ["page"]))


def q_gender_by_churn(spark, sf):
    return explore.count_users_by(_users_slice(spark, sf), "gender", "churn")


def q_last_level_by_churn(spark, sf):
    return explore.last_level_by(rare(spark, sf, ["userId", "ts", "page", "level"]), PAGES)


def q_entry_level_counts(spark, sf):
    return explore.entry_level(with_tied_times(act(spark, sf, ["userId", "ts", "level"])))


def q_registration_by_churn(spark, sf):
    # The user rows are read once, for their value counts.
    return round_doubles(explore.registration_spread(_users_slice(spark, sf).select("churn", "registration"), "churn"))


def q_distinct_users(spark, sf):
    return act(spark, sf, ["userId"]).select("userId").distinct()


def q_user_profile(spark, sf):
    return _users_slice(spark, sf)


def q_first_events(spark, sf):
    return explore.first_events(with_tied_times(act(spark, sf, ["userId", "ts", "level"])))


def q_last_events(spark, sf):
    return explore.last_events(with_tied_times(act(spark, sf, ["userId", "ts", "level"])))


def q_session_last_items(spark, sf):
    # Read twice (top item, rows at it): the position index of the test tables
    # is built and written once.
    a = materialize(act(spark, sf, ["userId", "sessionId", "itemInSession", "ts"]))
    return features.session_last_items(a, ["userId"])


def q_last_state(spark, sf):
    return features.last_state_table(_source(spark, sf), PLAN)


def q_top_pages(spark, sf):
    return explore.page_frequency(act(spark, sf, ["page"]), limit=99)


def q_latest_occurrences(spark, sf):
    return explore.occurrences(act(spark, sf, ["userId", "ts", "page"]), CHURN_PAGE, limit=20)


def q_cutoff_table(spark, sf):
    return windows.window_coverage(clean.drop_anonymous(act(spark, sf, ["userId", "ts"], plan_days(PLAN), True)), PLAN)


def q_offset_plan(spark, sf):
    return windows.plan_offsets(act(spark, sf, ["ts"]), PLAN.look_back_days, PLAN.look_ahead_days,
                                PLAN.interval_days)


def q_behaviour_features(spark, sf):
    return round_doubles(features.behaviour_features(_source(spark, sf), PLAN, PAGES))


def q_session_depth(spark, sf):
    return round_doubles(features.session_depth_table(_source(spark, sf), PLAN))


def q_lifecycle_labels(spark, sf):
    return features.labels_table(_source(spark, sf), PLAN, PAGES)


def q_join_session_depth(spark, sf):
    return round_doubles(features.joined_parts(_source(spark, sf), PLAN, PAGES, "depth"))


def q_join_last_state(spark, sf):
    return round_doubles(features.joined_parts(_source(spark, sf), PLAN, PAGES, "state"))


def q_join_labels(spark, sf):
    return round_doubles(features._finish(features.joined_parts(_source(spark, sf), PLAN, PAGES, "labels")))


def q_feature_table(spark, sf):
    return round_doubles(_ft(spark, sf))


def q_split_train(spark, sf):
    return round_doubles(_split(spark, sf)[0])


def q_split_test(spark, sf):
    return round_doubles(_split(spark, sf)[1])


def q_split_sizes(spark, sf):
    ft = _ft(spark, sf)
    parts = ft.withColumn("side", sampling.split_side(ft, SPLIT_RATIO, SPLIT_SEED, key="user"))
    return parts.groupBy("side").agg(F.count(F.lit(1)).alias("n_rows"),
                                     F.count_distinct("base_user").alias("n_users"))


def q_rebalanced(spark, sf):
    return round_doubles(_rebalanced(spark, sf, _ft_written(spark, sf)))


def q_rebalanced_class_counts(spark, sf):
    return sampling.class_counts(_rebalanced(spark, sf, _ft_written(spark, sf)), LABEL)


def q_class_counts(spark, sf):
    return sampling.class_counts(_ft(spark, sf), LABEL)


def q_scaled_features(spark, sf):
    from userflow.plans.modeling import scaled_features

    return round_doubles(scaled_features(_ft_written(spark, sf), ["userId"]))


def q_evaluation_metrics(spark, sf):
    labels = read_table(spark, sf, "labels")
    return round_doubles(metrics(labels, "quality", "toxic"))


def q_evaluation_by_dataset(spark, sf):
    # One pass over the written feature table: each row is tagged with its
    # split side and, when the rebalanced train set keeps it, 'rebalanced' too.
    ft = _ft_written(spark, sf)
    side = sampling.split_side(ft, SPLIT_RATIO, SPLIT_SEED, key="user")
    keep = sampling.rebalance_condition(_split(spark, sf, ft)[0], LABEL, REBALANCE_SEED, key="userId")
    in_rebalanced = (side == F.lit("train")) & (F.lit(True) if keep is None else keep)
    names = F.when(in_rebalanced, F.array(side, F.lit("rebalanced"))).otherwise(F.array(side))
    sets = ft.select("*", F.explode(names).alias("dataset"))
    return round_doubles(metrics(_with_rule(sets), LABEL, by=["dataset"]))


def _log(spark, sf):
    """All columns of the known users' activity over the plan's days."""
    return act(spark, sf, between=plan_days(PLAN), known_users=True)


def q_feature_table_from_days(spark, sf):
    """The feature table from stored day partials: the earlier days arrive at
    once, one day in two batches, and one day is written wrongly and replaced."""
    path = shared_path(spark, "day_store")
    log = materialize(_log(spark, sf))
    day = F.expr(f"ts div {DAY_MS}")
    last = PLAN.cutoff_ms // DAY_MS - 1
    late = F.expr(f"pmod(ts, {DAY_MS}) >= {DAY_MS // 2}")
    day_store.store_days(log.where(day < last - 1), path, PAGES)
    day_store.store_days(log.where((day == last - 1) & ~late), path, PAGES)
    day_store.store_days(log.where((day == last - 1) & late), path, PAGES)
    day_store.store_days(log.where((day >= last) & late), path, PAGES)
    day_store.store_days(log.where(day >= last), path, PAGES, mode="replace_days")
    return round_doubles(day_store.feature_table_from_days(spark, path, PLAN))


#: Rows of a user (of the test tables) from which the rows are kept out of the buckets.
HOT_USER_ROWS = 70


def _stored_by_user(spark, log, name):
    return user_buckets.store_by_user(log, f"{name}_{uuid.uuid4().hex}", 8, HOT_USER_ROWS)


def q_join_labels_bucketed(spark, sf):
    """The chain of joins on a log stored by user."""
    stored = _stored_by_user(spark, act(spark, sf), "activity")
    return round_doubles(user_buckets.by_user(
        spark, stored, lambda log, _: features._finish(features.joined_parts(log, PLAN, PAGES, "labels"))))


def q_user_lifecycle_flags_bucketed(spark, sf):
    """Flags spread to every row of a log stored by user."""
    stored = _stored_by_user(spark, rare(spark, sf, ["userId", "ts", "page"]), "rare")
    return user_buckets.by_user(spark, stored, lambda log, known: explore.with_lifecycle_flags(log, PAGES, known_users=known))


def q_last_events_bucketed(spark, sf):
    """Rows at each user's last (tied) time, of a log stored by user."""
    stored = _stored_by_user(spark, with_tied_times(act(spark, sf, ["userId", "ts", "level"])), "tied")
    return user_buckets.by_user(spark, stored, lambda log, known: explore.last_events(log, known_users=known))


#: Rule-based prediction over several features, for the importance query.
IMPORTANCE_RULE = ("CASE WHEN 3 * cnt_cc + 2 * cnt_sd - cnt_su + last_paid - 2 * last_female "
                   "+ total_length / 200 >= 30 THEN 1.0 ELSE 0.0 END")
IMPORTANCE_SEED, IMPORTANCE_BUCKETS = 31, 8


def q_permutation_importance(spark, sf):
    return round_doubles(importance.permutation_importance(
        _ft_written(spark, sf), LABEL, IMPORTANCE_RULE, FEATURES, "userId", IMPORTANCE_SEED, IMPORTANCE_BUCKETS))


# --- SQL side (DuckDB) ------------------------------------------------------

ACT_SQL = """act as (
select cast(e.user_id as varchar) as userId,
       epoch_us(e.ts)//1000 as ts,
       e.event_type as page,
       epoch_us(date_trunc('day', e.ts))//86400000000 as sessionId,
       row_number() over (partition by e.user_id, date_trunc('day', e.ts)
                          order by e.ts, e.event_id) - 1 as itemInSession,
       case when e.value >= 50 then 'paid' else 'free' end as level,
       case when c.c_custkey % 2 = 0 then 'F' else 'M' end as gender,
       epoch_us(r.reg)//1000 as registration,
       case when e.event_type = 'view' then e.value end as length
from events e
left join customer c on c.c_custkey = e.user_id
left join (select o_custkey, min(o_orderdate) as reg from orders group by 1) r
       on r.o_custkey = e.user_id)"""

ANON_SQL = """anon as (
select case when try_cast(userId as bigint) % 50 = 0 then ''
            when try_cast(userId as bigint) % 50 = 1 then null else userId end as userId,
       ts, page, sessionId, itemInSession, level, gender,
       case when try_cast(userId as bigint) % 7 = 0 then null else registration end as registration,
       length
from act)"""

C, B, L, N = PLAN.cutoff_ms, PLAN.back_ms, PLAN.ahead_ms, PLAN.n_extra
D = "86400000.0::double"


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


WIN_SQL = f"""clean as (select * from act where userId is not null and userId <> ''),
cut as (select i as offset_idx, {C} - {PLAN.step_ms} * i as cutoff_ms from range(0, {N + 1}) t(i)),
win as (select c.*, k.offset_idx, k.cutoff_ms, c.ts < k.cutoff_ms as in_train
        from clean c join cut k on c.ts >= k.cutoff_ms - {B} and c.ts < k.cutoff_ms + {L}),
tr as (select * from win where in_train),
la as (select * from win where not in_train)"""

_COUNTS = ",\n       ".join(
    f"count(*) filter (where page = {_lit(PAGES[c])}) as {count_column(c)}" for c, _ in PAGE_CODES
)
BEH_SQL = f"""beh as (
select userId, offset_idx, max(cutoff_ms) as cutoff_ms,
       {_COUNTS},
       cast(sum(cast(coalesce(length, 0.0) as decimal(18,6))) as double) as total_length,
       max(coalesce((cutoff_ms - registration) / {D}, 0.0)) as tenure_days
from tr group by userId, offset_idx)"""

DEP_SQL = """smax as (select userId, offset_idx, sessionId, max(itemInSession) as m from tr group by 1, 2, 3),
dep as (select t.userId, t.offset_idx, avg(t.itemInSession) as avg_session_depth
        from tr t join smax s on t.userId = s.userId and t.offset_idx = s.offset_idx
         and t.sessionId is not distinct from s.sessionId and t.itemInSession = s.m
        group by 1, 2)"""

LST_SQL = """lmax as (select userId, offset_idx, max(ts) as mt from tr group by 1, 2),
lst as (select t.userId, t.offset_idx,
               max(case when level = 'paid' then 1 else 0 end) as last_paid,
               max(case when gender = 'F' then 1 else 0 end) as last_female
        from tr t join lmax m on t.userId = m.userId and t.offset_idx = m.offset_idx and t.ts = m.mt
        group by 1, 2)"""

LAB_SQL = f"""lab as (select userId, offset_idx,
       max(case when page = {_lit(PAGES['SU'])} then 1 else 0 end) as upgrade,
       max(case when page = {_lit(PAGES['SD'])} then 1 else 0 end) as downgrade,
       max(case when page = {_lit(PAGES['CC'])} then 1 else 0 end) as churn
from la group by 1, 2)"""


def _feature_expr(name: str) -> str:
    if name == "avg_session_depth":
        return "coalesce(d.avg_session_depth, 0.0) as avg_session_depth"
    if name in ("last_paid", "last_female"):
        return f"coalesce(s.{name}, 0) as {name}"
    return f"b.{name}"


FT_SQL = f"""{BEH_SQL},
{DEP_SQL},
{LST_SQL},
{LAB_SQL},
ft as (
select b.userId || '_x' || b.offset_idx as userId, b.userId as base_user, b.offset_idx, b.cutoff_ms,
       {", ".join(_feature_expr(f) for f in FEATURES)},
       coalesce(l.upgrade, 0) as upgrade, coalesce(l.downgrade, 0) as downgrade, coalesce(l.churn, 0) as churn
from beh b
left join dep d on d.userId = b.userId and d.offset_idx = b.offset_idx
left join lst s on s.userId = b.userId and s.offset_idx = b.offset_idx
left join lab l on l.userId = b.userId and l.offset_idx = b.offset_idx)"""


def _hash(expr: str, seed: int) -> str:
    return f"('0x' || substr(md5(cast({expr} as varchar) || '|{seed}'), 1, 8))::BIGINT"


SPLIT_SQL = f"""tr_set as (select * from ft where {_hash('base_user', SPLIT_SEED)} < {int(SPLIT_RATIO * (1 << 32))}),
te_set as (select * from ft where not ({_hash('base_user', SPLIT_SEED)} < {int(SPLIT_RATIO * (1 << 32))})),
cc as (select {LABEL} as v, count(*) as n from tr_set group by 1),
mm as (select (select v from cc order by n, v limit 1) as minor_val, min(n) as n_minor, max(n) as n_major from cc),
rb_set as (select t.* from tr_set t, mm
           where mm.n_minor = mm.n_major or t.{LABEL} = mm.minor_val
              or cast({_hash('t.userId', REBALANCE_SEED)} as hugeint) * mm.n_major
                 < cast(mm.n_minor as hugeint) * 4294967296)"""


def _with(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


def _round(select_sql: str, doubles: list[str]) -> str:
    rep = ", ".join(f"round({c}, 6) + 0.0 as {c}" for c in doubles)
    return f"select * replace ({rep}) from ({select_sql}) q"


FT_ALL = _with(ACT_SQL, WIN_SQL, FT_SQL)
SPLIT_ALL = _with(ACT_SQL, WIN_SQL, FT_SQL, SPLIT_SQL)

_FLAGS = ",\n       ".join(
    f"max(case when page = {_lit(PAGES[code])} then 'Yes' else 'No' end) as {name}"
    for name, code in (("churn", "CC"), ("upgrade", "SU"), ("downgrade", "SD"))
)
_RARE = ", ".join(_lit(p) for p in label_pages(PAGES).values())
SLICE_SQL = f"""sl as (select * replace (case when page in ({_RARE}) and (ts // 1000) % {RARE_EVERY} <> 0
                                  then {_lit(RARE_PAGE)} else page end as page) from act),
uf as (select userId,
       {_FLAGS}
from sl group by userId)"""
PROFILE_SQL = f"""up as (select userId,
       {_FLAGS},
       arg_max(gender, ts) as gender, arg_max(level, ts) as level, arg_max(registration, ts) as registration
from sl group by userId)"""

_LC = {name: PAGES[code] for name, code in (("churn", "CC"), ("downgrade", "SD"), ("upgrade", "SU"))}
_SPREAD = ", ".join(
    [f"quantile_cont(registration, {q}) / {D} as p{int(q * 100):02d}_day" for q in explore.QUANTILES]
)
_METRICS = f"""tp, tn, fp, fn, tp + tn + fp + fn as total,
       tp::double / nullif(tp + fn, 0) as recall,
       tp::double / nullif(tp + fp, 0) as precision,
       (tp + tn)::double / nullif(tp + tn + fp + fn, 0) as accuracy,
       2.0 * (tp::double / nullif(tp + fn, 0)) * (tp::double / nullif(tp + fp, 0))
           / nullif(tp::double / nullif(tp + fn, 0) + tp::double / nullif(tp + fp, 0), 0) as f1"""
_CONF = """count(*) filter (where {y} = 1 and {p} = 1) as tp,
       count(*) filter (where {y} = 0 and {p} = 0) as tn,
       count(*) filter (where {y} = 0 and {p} = 1) as fp,
       count(*) filter (where {y} = 1 and {p} = 0) as fn"""
_RATIOS = ["recall", "precision", "accuracy", "f1"]


def _importance_sql() -> str:
    """Accuracy of the rule with each feature taken from the next row of its
    bucket (the first one's for the last row)."""
    own = ", ".join(f"'{f}': {f}" for f in FEATURES)

    def accuracy(feature: str | None) -> str:
        rule = IMPORTANCE_RULE if feature is None else re.sub(rf"\b{feature}\b", f"donor.{feature}", IMPORTANCE_RULE)
        return f"select {_lit(feature or '')} as feature, avg(case when {LABEL} = {rule} then 1.0 else 0.0 end) as acc from d"

    tried = " union all ".join(accuracy(f) for f in [None, *FEATURES])
    return _with(ACT_SQL, WIN_SQL, FT_SQL,
                 f"o as (select *, {_hash('userId', IMPORTANCE_SEED)} as h, {{{own}}} as own from ft)",
                 f"""d as (select *, coalesce(lead(own) over w, first(own) over w) as donor from o
                     window w as (partition by h % {IMPORTANCE_BUCKETS} order by h, userId))""",
                 f"t as ({tried})") + _round(
        "select t.feature, b.acc as baseline_accuracy, t.acc as permuted_accuracy, b.acc - t.acc as importance, "
        "row_number() over (order by round(b.acc - t.acc, 9) desc, t.feature) as rank "
        "from t join t b on b.feature = '' where t.feature <> ''",
        ["baseline_accuracy", "permuted_accuracy", "importance"])


def _sql() -> dict[str, str]:
    a = _with(ACT_SQL)
    an = _with(ACT_SQL, ANON_SQL)
    tied = _with(ACT_SQL, "tied as (select * replace (ts - ts % 43200000 as ts) from act)")
    w = _with(ACT_SQL, WIN_SQL)
    sl = _with(ACT_SQL, SLICE_SQL)
    pr = _with(ACT_SQL, SLICE_SQL, PROFILE_SQL)
    churn = _lit(CHURN_PAGE)
    excl = ", ".join(_lit(i) for i in EXCLUDED)
    s_start, s_end = C - B, C
    flags = ", ".join(f"case when page = {_lit(PAGES[c])} then 1 else 0 end as is_{c.lower()}" for c, _ in PAGE_CODES)
    churned = (f"(select distinct userId from act where {_hash('userId', SPLIT_SEED)} < "
               f"{int(SPLIT_RATIO * (1 << 32))})")
    nulls = ", ".join(f"count(*) filter (where {c} is null) as null_{c}" for c in
                      ["userId", "ts", "page", "sessionId", "itemInSession", "level", "gender", "registration",
                       "length"])
    q: dict[str, str] = {
        "activity_scan": a + "select * from act",
        "column_null_profile": an + f"select count(*) as n_rows, {nulls} from anon",
        "clean_anonymous": an + "select * from anon where userId is not null and userId <> ''",
        "clean_excluded_users": an + f"select * from anon where userId is not null and userId not in ({excl})",
        "users_missing_registration": an + (
            "select distinct 'before' as stage, userId from anon where registration is null\n"
            "union all\n"
            "select distinct 'after' as stage, userId from anon where registration is null "
            "and userId is not null and userId <> ''"),
        "event_occurrences": a + f"select userId, ts from act where page = {churn}",
        "window_slice": a + f"select * from act where ts >= {s_start} and ts < {s_end}",
        "split_members": a + f"select * from act where userId in {churned}",
        "split_non_members": a + f"select * from act where userId not in {churned}",
        "page_flags": a + f"select userId, ts, {flags} from act",
        "tenure_days": an + _round(
            f"select userId, ts, coalesce(({C} - registration) / {D}, 0.0) as tenure_days from anon",
            ["tenure_days"]),
        "length_filled": a + "select userId, ts, coalesce(length, 0.0) as length_filled from act",
        "offset_ids": w + "select distinct userId, offset_idx, userId || '_x' || offset_idx as offset_user from tr",
        "daily_log_count": a + "select (ts // 86400000) * 86400 as day, count(ts) as n_logs from act group by 1",
        "daily_lifecycle_counts": a + (
            "select (ts // 86400000) * 86400 as day, "
            + ", ".join(f"count(*) filter (where page = {_lit(v)}) as n_{k}" for k, v in _LC.items())
            + " from act group by 1"),
        "user_lifecycle_flags": sl + (
            "select s.userId, s.ts, s.page, f.churn, f.upgrade, f.downgrade "
            "from sl s join uf f on f.userId = s.userId"),
        "users_by_churn": sl + "select churn, count(*) as n_users from uf group by 1",
        "users_by_upgrade": sl + "select upgrade, count(*) as n_users from uf group by 1",
        "users_by_downgrade": sl + "select downgrade, count(*) as n_users from uf group by 1",
        "users_by_flag_combo": sl + "select churn, upgrade, downgrade, count(*) as n_users from uf group by 1, 2, 3",
        "page_frequency": a + "select page, count(page) as n from act group by 1",
        "gender_by_churn": pr + "select gender, churn, count(*) as n_users from up group by 1, 2",
        "last_level_by_churn": sl + (
            "select s.level, f.churn, count(*) as n from sl s "
            "join (select userId, max(ts) as mt from sl group by 1) m on m.userId = s.userId and s.ts = m.mt "
            "join uf f on f.userId = s.userId group by 1, 2"),
        "entry_level_counts": tied + (
            "select a.level, count(a.level) as n from tied a "
            "join (select userId, min(ts) as mt from tied group by 1) m on m.userId = a.userId and a.ts = m.mt "
            "group by 1"),
        "registration_by_churn": pr + _round(
            f"select churn, count(registration) as n_users, {_SPREAD}, min(registration / {D}) as min_day, "
            f"max(registration / {D}) as max_day, avg(registration / {D}) as avg_day from up group by 1",
            [f"p{int(q * 100):02d}_day" for q in explore.QUANTILES] + ["min_day", "max_day", "avg_day"]),
        "distinct_users": a + "select distinct userId from act",
        "user_profile": pr + "select * from up",
        "first_events": tied + (
            "select a.userId, a.ts, a.level from tied a "
            "join (select userId, min(ts) as mt from tied group by 1) m on m.userId = a.userId and a.ts = m.mt"),
        "last_events": tied + (
            "select a.userId, a.ts, a.level from tied a "
            "join (select userId, max(ts) as mt from tied group by 1) m on m.userId = a.userId and a.ts = m.mt"),
        "session_last_items": a + (
            "select a.userId, a.sessionId, a.itemInSession, a.ts from act a "
            "join (select userId, sessionId, max(itemInSession) as m from act group by 1, 2) s "
            "on s.userId = a.userId and s.sessionId is not distinct from a.sessionId and a.itemInSession = s.m"),
        "last_state": _with(ACT_SQL, WIN_SQL, LST_SQL) + "select * from lst",
        "top_pages": a + "select page, count(page) as n from act group by 1 order by n desc, page limit 99",
        "latest_occurrences": a + (
            f"select userId, ts from act where page = {churn} order by ts desc, userId limit 20"),
        "cutoff_table": w + (
            f"select k.offset_idx, k.cutoff_ms, k.cutoff_ms - {B} as train_start_ms, "
            f"k.cutoff_ms + {L} as label_end_ms, c.n_train_rows, c.n_label_rows, c.n_users from cut k left join "
            "(select offset_idx, count(*) filter (where in_train) as n_train_rows, "
            "count(*) filter (where not in_train) as n_label_rows, "
            "count(distinct case when in_train then userId end) as n_users from win group by 1) c "
            "on c.offset_idx = k.offset_idx"),
        "offset_plan": a + (
            "select min_ts, max_ts, days as history_days, cutoff_ms, n_extra, "
            f"cutoff_ms - greatest(n_extra, 0) * {PLAN.step_ms} as earliest_cutoff_ms from ("
            f"select min_ts, max_ts, days, (last_day + 1 - {PLAN.look_ahead_days}) * 86400000 as cutoff_ms, "
            f"cast(floor((days - {PLAN.look_ahead_days + PLAN.look_back_days}) / "
            f"{float(PLAN.interval_days)}::double) as bigint) as n_extra from ("
            "select min(ts) as min_ts, max(ts) as max_ts, max(ts) // 86400000 as last_day, "
            "max(ts) // 86400000 - min(ts) // 86400000 + 1 as days from act) x) y"),
        "behaviour_features": _with(ACT_SQL, WIN_SQL, BEH_SQL) + _round(
            "select * from beh", ["total_length", "tenure_days"]),
        "session_depth": _with(ACT_SQL, WIN_SQL, DEP_SQL) + _round("select * from dep", ["avg_session_depth"]),
        "lifecycle_labels": _with(ACT_SQL, WIN_SQL, LAB_SQL) + "select * from lab",
        "join_session_depth": _with(ACT_SQL, WIN_SQL, BEH_SQL, DEP_SQL) + _round(
            "select b.*, d.avg_session_depth from beh b left join dep d "
            "on d.userId = b.userId and d.offset_idx = b.offset_idx",
            ["total_length", "tenure_days", "avg_session_depth"]),
        "join_last_state": _with(ACT_SQL, WIN_SQL, BEH_SQL, DEP_SQL, LST_SQL) + _round(
            "select b.*, d.avg_session_depth, s.last_paid, s.last_female from beh b "
            "left join dep d on d.userId = b.userId and d.offset_idx = b.offset_idx "
            "left join lst s on s.userId = b.userId and s.offset_idx = b.offset_idx",
            ["total_length", "tenure_days", "avg_session_depth"]),
        "join_labels": FT_ALL + _round("select * from ft", DOUBLE_FEATURES),
        "feature_table": FT_ALL + _round("select * from ft", DOUBLE_FEATURES),
        "feature_table_from_days": FT_ALL + _round("select * from ft", DOUBLE_FEATURES),
        "join_labels_bucketed": FT_ALL + _round("select * from ft", DOUBLE_FEATURES),
        "user_lifecycle_flags_bucketed": sl + (
            "select s.userId, s.ts, s.page, f.churn, f.upgrade, f.downgrade "
            "from sl s join uf f on f.userId = s.userId"),
        "last_events_bucketed": tied + (
            "select a.userId, a.ts, a.level from tied a "
            "join (select userId, max(ts) as mt from tied group by 1) m on m.userId = a.userId and a.ts = m.mt"),
        "permutation_importance": _importance_sql(),
        "split_train": SPLIT_ALL + _round("select * from tr_set", DOUBLE_FEATURES),
        "split_test": SPLIT_ALL + _round("select * from te_set", DOUBLE_FEATURES),
        "split_sizes": SPLIT_ALL + (
            "select 'train' as side, count(*) as n_rows, count(distinct base_user) as n_users from tr_set "
            "union all select 'test', count(*), count(distinct base_user) from te_set"),
        "rebalanced": SPLIT_ALL + _round("select * from rb_set", DOUBLE_FEATURES),
        "rebalanced_class_counts": SPLIT_ALL + f"select {LABEL}, count(*) as n from rb_set group by 1",
        "class_counts": FT_ALL + f"select {LABEL}, count(*) as n from ft group by 1",
        "scaled_features": FT_ALL + "select userId, " + ", ".join(
            f"coalesce(round(({f} - avg({f}) over ()) / nullif(stddev_samp({f}) over (), 0), 6), 0.0) + 0.0 as {f}"
            for f in FEATURES) + " from ft",
        "evaluation_metrics": _round(
            "select " + _METRICS + " from (select " + _CONF.format(y="quality", p="toxic") + " from labels) c",
            _RATIOS),
        "evaluation_by_dataset": SPLIT_ALL + _round(
            "select dataset, " + _METRICS + " from (select dataset, " + _CONF.format(y=LABEL, p="prediction")
            + f" from (select *, case when cnt_cc >= {RULE_MIN_CC} then 1.0 else 0.0 end as prediction from ("
            "select 'train' as dataset, * from tr_set union all select 'test', * from te_set "
            "union all select 'rebalanced', * from rb_set) u) p group by dataset) c",
            _RATIOS),
    }
    return q


SQL_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "activity_scan": q_activity_scan,
    "column_null_profile": q_column_null_profile,
    "clean_anonymous": q_clean_anonymous,
    "clean_excluded_users": q_clean_excluded_users,
    "users_missing_registration": q_users_missing_registration,
    "event_occurrences": q_event_occurrences,
    "window_slice": q_window_slice,
    "split_members": q_split_members,
    "split_non_members": q_split_non_members,
    "page_flags": q_page_flags,
    "tenure_days": q_tenure_days,
    "length_filled": q_length_filled,
    "offset_ids": q_offset_ids,
    "daily_log_count": q_daily_log_count,
    "daily_lifecycle_counts": q_daily_lifecycle_counts,
    "user_lifecycle_flags": q_user_lifecycle_flags,
    "users_by_churn": _by_flag("churn"),
    "users_by_upgrade": _by_flag("upgrade"),
    "users_by_downgrade": _by_flag("downgrade"),
    "users_by_flag_combo": q_users_by_flag_combo,
    "page_frequency": q_page_frequency,
    "gender_by_churn": q_gender_by_churn,
    "last_level_by_churn": q_last_level_by_churn,
    "entry_level_counts": q_entry_level_counts,
    "registration_by_churn": q_registration_by_churn,
    "distinct_users": q_distinct_users,
    "user_profile": q_user_profile,
    "first_events": q_first_events,
    "last_events": q_last_events,
    "session_last_items": q_session_last_items,
    "last_state": q_last_state,
    "top_pages": q_top_pages,
    "latest_occurrences": q_latest_occurrences,
    "cutoff_table": q_cutoff_table,
    "offset_plan": q_offset_plan,
    "behaviour_features": q_behaviour_features,
    "session_depth": q_session_depth,
    "lifecycle_labels": q_lifecycle_labels,
    "join_session_depth": q_join_session_depth,
    "join_last_state": q_join_last_state,
    "join_labels": q_join_labels,
    "feature_table": q_feature_table,
    "feature_table_from_days": q_feature_table_from_days,
    "join_labels_bucketed": q_join_labels_bucketed,
    "user_lifecycle_flags_bucketed": q_user_lifecycle_flags_bucketed,
    "last_events_bucketed": q_last_events_bucketed,
    "permutation_importance": q_permutation_importance,
    "split_train": q_split_train,
    "split_test": q_split_test,
    "split_sizes": q_split_sizes,
    "rebalanced": q_rebalanced,
    "rebalanced_class_counts": q_rebalanced_class_counts,
    "class_counts": q_class_counts,
    "scaled_features": q_scaled_features,
    "evaluation_metrics": q_evaluation_metrics,
    "evaluation_by_dataset": q_evaluation_by_dataset,
}


def oracle_sql() -> dict[str, str]:
    return _sql()


def sql_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(SQL_QUERIES)


__all__ = ["SQL_QUERIES", "oracle_sql", "sql_queries", "PLAN", "PAGES", "FEATURE_ORDER", "LABELS", "DAY_MS"]
