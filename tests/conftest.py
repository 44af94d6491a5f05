import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from userflow.session import build_session  # noqa: E402
from userflow.sources.schema import DAY_MS, EVENTS, PAGE_CODES  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", shuffle_partitions=8, app="userflow-tests")
    yield s
    s.stop()


def event(user, ts, page="NextSong", session=1, item=0, level="free", gender="M", registration=0, length=None):
    return (user, ts, page, session, item, level, gender, registration, length)


def make_log(spark, rows):
    return spark.createDataFrame(rows, EVENTS)


def random_log(spark, seed=7, users=60, n=5000, days=22, start_ms=1_700_000_000_000 // DAY_MS * DAY_MS):
    """Seeded log on whole hours (so timestamps tie), with nulls in every
    nullable field and all page values."""
    rng = random.Random(seed)
    pages = [name for _, name in PAGE_CODES] + [None]
    rows = []
    for _ in range(n):
        u = rng.randrange(users)
        rows.append(
            (
                str(u),
                start_ms + rng.randrange(days * 24) * 3_600_000,
                rng.choice(pages),
                rng.choice([1, 2, 3, None]),
                rng.choice([0, 1, 2, 3, 4, 5, None]),
                rng.choice(["paid", "free"]),
                rng.choice(["F", "M"]),
                None if u % 7 == 0 else start_ms - (u + 1) * DAY_MS,
                rng.choice([None, 1.25, 2.5]),
            )
        )
    return spark.createDataFrame(rows, EVENTS)
