"""Event schema, page vocabulary and feature order.

Everything here is a contract with the activity log and with fitted models;
change it and saved pipelines no longer line up with their input columns.
"""

from __future__ import annotations

from pyspark.sql import types as T

DAY_MS = 86_400_000

# One row per page view.  Time is a long of epoch milliseconds.
EVENTS = T.StructType(
    [
        T.StructField("userId", T.StringType(), True),
        T.StructField("ts", T.LongType(), True),
        T.StructField("page", T.StringType(), True),
        T.StructField("sessionId", T.LongType(), True),
        T.StructField("itemInSession", T.LongType(), True),
        T.StructField("level", T.StringType(), True),
        T.StructField("gender", T.StringType(), True),
        T.StructField("registration", T.LongType(), True),
        T.StructField("length", T.DoubleType(), True),
    ]
)
EVENT_COLUMNS = [f.name for f in EVENTS.fields]

# --- fixed values -----------------------------------------------------------
# Page codes and the page names of the music-service log, in the order the
# behaviour features are defined.
PAGE_CODES = [
    ("NS", "NextSong"),
    ("HO", "Home"),
    ("TU", "Thumbs Up"),
    ("AP", "Add to Playlist"),
    ("RA", "Roll Advert"),
    ("AF", "Add Friend"),
    ("LO", "Login"),
    ("TD", "Thumbs Down"),
    ("DO", "Downgrade"),
    ("HE", "Help"),
    ("SE", "Settings"),
    ("AB", "About"),
    ("UP", "Upgrade"),
    ("SS", "Save Settings"),
    ("ER", "Error"),
    ("SU", "Submit Upgrade"),
    ("SD", "Submit Downgrade"),
    ("CA", "Cancel"),
    ("CC", "Cancellation Confirmation"),
    ("RE", "Register"),
    ("SR", "Submit Registration"),
]
# Lifecycle labels: label name -> page code whose occurrence sets it.
LABEL_CODES = [("upgrade", "SU"), ("downgrade", "SD"), ("churn", "CC")]
# Order of the 26 model inputs, as in the fitted pipelines.  Page codes stand
# for their counts; LEN = summed length, TEN = tenure days, DEP = average
# session depth, PAID / FEM = level and gender at the last event.
FEATURE_ORDER = [
    "RA", "NS", "HE", "SD", "LEN", "AF", "ER", "CC", "TEN", "HO", "SE", "UP", "TU",
    "SS", "LO", "RE", "DO", "SU", "AB", "AP", "CA", "TD", "SR", "DEP", "PAID", "FEM",
]
# Page names on the driver test tables (event_type values); codes not listed
# keep the log's own page names and therefore count zero there.
TABLE_PAGE_NAMES = {"NS": "view", "TU": "click", "SU": "purchase", "SD": "signup", "CC": "error"}
# --- end of fixed values -----------------------------------------------------

LOG_PAGES: dict[str, str] = dict(PAGE_CODES)
TABLE_PAGES: dict[str, str] = {**LOG_PAGES, **TABLE_PAGE_NAMES}

_SPECIAL = {
    "LEN": "total_length",
    "TEN": "tenure_days",
    "DEP": "avg_session_depth",
    "PAID": "last_paid",
    "FEM": "last_female",
}


def count_column(code: str) -> str:
    """Output column name of a page count, e.g. ``cnt_ns``."""
    return f"cnt_{code.lower()}"


def feature_columns() -> list[str]:
    """The 26 feature column names in model input order."""
    return [_SPECIAL.get(c, count_column(c) if c in LOG_PAGES else c) for c in FEATURE_ORDER]


LABELS = [name for name, _ in LABEL_CODES]


def label_pages(pages: dict[str, str]) -> dict[str, str]:
    """Label name -> page string under a page vocabulary."""
    return {name: pages[code] for name, code in LABEL_CODES}


def check_schema(df, expected: T.StructType = EVENTS) -> None:
    """Raise if ``df`` lacks a column of ``expected`` or carries it with another type."""
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for f in expected.fields:
        if f.name not in have:
            problems.append(f"missing {f.name}")
        elif have[f.name] != f.dataType:
            problems.append(f"{f.name}: {have[f.name].simpleString()} != {f.dataType.simpleString()}")
    if problems:
        raise ValueError("event schema mismatch: " + "; ".join(problems))
