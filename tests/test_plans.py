"""Plan shape of every SQL-checked registered query of the library (sf0.001; the
queries that write intermediate tables run those steps): no pair-producing joins,
no row-at-a-time Python, row limits only where the limit is the feature, and
every window runs over bounded ranges (`_split`), never over a whole user, day or
class."""

import re

import pytest

from conftest import SF_SMALL

import __spark_entry__ as entry_mod
from userflow.plans import registry

QUERIES = entry_mod.queries()
SQL_CHECKED = sorted(registry.oracle_sql())

# Top-k reports: the row limit is what the query asks for.
TOP_K = {"top_pages", "latest_occurrences"}


def _plan(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", SQL_CHECKED)
def test_plan_shape(spark, name):
    plan = _plan(spark, name)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert node not in plan, f"{name}: {node}"
    if name not in TOP_K:
        assert not re.search(r"\b(GlobalLimit|LocalLimit|CollectLimit|TakeOrderedAndProject)\b", plan), name
    for line in plan.splitlines():
        if re.search(r"\bWindow \[", line):
            assert "_split" in line, f"{name}: window without a chunk key: {line.strip()[:200]}"


# Queries that once re-read the log per branch; they read it in one pass now
# (registration_by_churn reads only its written per-user rows).
MAX_SCANS = {"registration_by_churn": 6, "users_missing_registration": 2, "split_sizes": 3, "tenure_days": 2,
             "session_last_items": 2, "last_level_by_churn": 2}


@pytest.mark.parametrize("name", sorted(MAX_SCANS))
def test_scan_counts(spark, name):
    plan = _plan(spark, name)
    assert plan.count("FileScan parquet") <= MAX_SCANS[name], name
    if name == "registration_by_churn":
        assert "event_type" not in " ".join(re.findall(r"FileScan parquet \[([^\]]*)\]", plan)), "log re-read"
