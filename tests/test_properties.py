"""Property-based equivalence: production form == join form on generated logs
and window settings (ties on timestamps, nulls in every nullable field)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import make_log
from userflow.operators.features import feature_table, feature_table_literal
from userflow.operators.windows import CutoffPlan
from userflow.sources.schema import DAY_MS, LOG_PAGES, PAGE_CODES

BASE = 1_700_000_000_000 // DAY_MS * DAY_MS
HOUR = 3_600_000

row = st.tuples(
    st.sampled_from(["a", "b", "c", "", None]),
    st.integers(0, 30 * 24).map(lambda h: BASE + h * HOUR),
    st.sampled_from([name for _, name in PAGE_CODES][:8] + [None]),
    st.sampled_from([1, 2, None]),
    st.sampled_from([0, 1, 2, None]),
    st.sampled_from(["paid", "free", None]),
    st.sampled_from(["F", "M", None]),
    st.sampled_from([BASE - DAY_MS, BASE + 40 * DAY_MS, None]),
    st.sampled_from([None, 1.5, 2.25]),
)

plans = st.builds(
    lambda cut_day, cut_hour, back, ahead, extra, step: CutoffPlan(
        BASE + cut_day * DAY_MS + cut_hour * HOUR, back, ahead, extra, step),
    st.integers(5, 30), st.integers(0, 23), st.integers(1, 8), st.integers(1, 3), st.integers(0, 4),
    st.integers(1, 5),
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(row, min_size=1, max_size=60), plan=plans)
def test_forms_agree(spark, rows, plan):
    log = make_log(spark, rows)
    a = feature_table(log, plan, LOG_PAGES)
    b = feature_table_literal(log, plan, LOG_PAGES)
    assert a.exceptAll(b).count() == 0
    assert b.exceptAll(a).count() == 0
