"""Column expressions used across the operators.

All are built-in Catalyst expressions, so they stay inside whole-stage codegen
and never leave the JVM.  They are written as SQL expression text (``*_sql``
helpers compose text, the plain helpers wrap it with ``F.expr``): one parse
in the JVM instead of a round trip per nested function call.  Arguments are
column names or SQL expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from userflow.sources.schema import DAY_MS


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + str(s).replace("\\", "\\\\").replace("'", "\\'") + "'"


def e(sql: str, alias: str | None = None) -> Column:
    c = F.expr(sql)
    return c.alias(alias) if alias else c


def epoch_ms(ts: str, session_tz: str = "UTC") -> Column:
    """Epoch milliseconds (floor) of a ``timestamp_ntz`` column read as UTC wall time.

    ``cast(ntz as timestamp)`` reads the wall time in the session zone; under
    another zone the value is first moved from UTC to that zone, so the
    result never depends on the session setting.  Plain arithmetic, cheap
    enough to be repeated where the optimizer inlines it into filters.
    """
    src = ts if session_tz == "UTC" else f"convert_timezone('UTC', {q(session_tz)}, {ts})"
    return e(floor_div_sql(f"unix_micros(cast({src} as timestamp))", 1000))


def floor_div_sql(a: str, d: int) -> str:
    """Exact integer floor division by a positive constant."""
    return f"((({a}) - pmod({a}, {int(d)})) div {int(d)})"


def ceil_div_sql(a: str, d: int) -> str:
    return f"(-{floor_div_sql(f'-({a})', d)})"


def floor_div(a: str, d: int) -> Column:
    return e(floor_div_sql(a, d))


def page_flag_sql(page: str, name: str) -> str:
    """1 when the page equals ``name``, else 0 (null page -> 0)."""
    return f"CASE WHEN {page} = {q(name)} THEN 1 ELSE 0 END"


def page_flag(page: str, name: str) -> Column:
    return e(page_flag_sql(page, name))


def tenure_days_sql(registration: str, cutoff_ms: str | int) -> str:
    """Days from registration to the cutoff; null registration -> 0.0."""
    return f"coalesce(({cutoff_ms} - {registration}) / {float(DAY_MS)}D, 0.0D)"


def tenure_days(registration: str, cutoff_ms: str | int) -> Column:
    return e(tenure_days_sql(registration, cutoff_ms))


def length_filled(length: str) -> Column:
    return e(f"coalesce({length}, 0.0D)")


def exact_length_sql(length: str) -> str:
    """Length as a fixed-point decimal, so sums do not depend on row order."""
    return f"cast(coalesce({length}, 0.0D) as decimal(18,6))"


def paid_flag_sql(level: str) -> str:
    return f"CASE WHEN {level} = 'paid' THEN 1 ELSE 0 END"


def female_flag_sql(gender: str) -> str:
    return f"CASE WHEN {gender} = 'F' THEN 1 ELSE 0 END"


def day_bucket(ts_ms: str) -> Column:
    """Epoch seconds of the UTC midnight starting the day of ``ts_ms``."""
    return e(f"{floor_div_sql(ts_ms, DAY_MS)} * 86400")


def offset_id_sql(user: str, offset: str) -> str:
    """``<user>_x<offset>``; null user stays null."""
    return f"concat({user}, '_x', cast({offset} as string))"


def hash_unit_sql(key: str, seed: int) -> str:
    return f"cast(conv(substring(md5(concat(cast({key} as string), '|{int(seed)}')), 1, 8), 16, 10) as bigint)"


def hash_unit(key: str, seed: int) -> Column:
    """Deterministic 32-bit bucket in [0, 2^32) of ``key`` and ``seed`` from md5.

    The same number is produced by SQL engines with md5 and hex parsing, which
    makes splits reproducible outside Spark and independent of partitioning.
    """
    return e(hash_unit_sql(key, seed))


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den as double, NULL when den is 0 or NULL (ANSI-safe)."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column; used where results are compared by value."""
    return df.select(*[
        e(f"round(`{name}`, {digits})", name) if t in ("double", "float") else F.col(f"`{name}`")
        for name, t in df.dtypes
    ])
