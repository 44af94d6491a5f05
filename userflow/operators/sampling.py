"""Seeded, partition-independent splitting and class rebalancing.

Both decide per row from a 32-bit md5 bucket of (key, seed), so the result
does not depend on partitioning, row order or retries, no id list is sent
to the driver, and all rows of one key fall on the same side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from userflow.functions.columns import hash_unit

TWO_32 = 1 << 32


def split_condition(key: str, ratio: float, seed: int) -> Column:
    """True for the train side: bucket < ratio * 2^32."""
    return hash_unit(key, seed) < F.lit(int(ratio * TWO_32))


def split_by_key(df: DataFrame, ratio: float, seed: int, key: str = "user") -> tuple[DataFrame, DataFrame]:
    """(train, test), ``ratio`` of the keys in train.

    ``key='user'`` splits on ``base_user`` when present (all offsets of one
    person on one side, no leakage); ``key='row'`` splits on ``userId`` (the
    offset-tagged id).  Any other value is taken as a column name.
    """
    cond = split_condition(_split_key(df, key), ratio, seed)
    return df.where(cond), df.where(~cond)


def split_side(df: DataFrame, ratio: float, seed: int, key: str = "user") -> Column:
    """``'train'`` / ``'test'`` per row, the same sides as :func:`split_by_key`,
    for queries that need both sides in one pass."""
    cond = split_condition(_split_key(df, key), ratio, seed)
    return F.when(cond, F.lit("train")).otherwise(F.lit("test"))


def _split_key(df: DataFrame, key: str) -> str:
    return {"user": "base_user" if "base_user" in df.columns else "userId", "row": "userId"}.get(key, key)


def split_by_ids(df: DataFrame, ids: DataFrame, key: str = "userId") -> tuple[DataFrame, DataFrame]:
    """(rows whose key is in ``ids``, the other rows), as semi / anti joins.

    Nothing is collected; the join strategy (broadcast or shuffle) is chosen
    by the optimizer from the measured size of ``ids``.  Where the id set is too
    big to broadcast and the log large, the semi join is shuffled and the
    optimizer sends a Bloom filter of the ids to the log's scan, so rows of other
    keys are dropped before the shuffle (limits in ``session.SESSION_CONF``).  It
    does so only for a side with a selective filter; :func:`_known` gives it one.
    Null ids match nothing.
    """
    ids = _known(ids.select(F.col(ids.columns[0]).alias("_id"))).distinct()
    cond = df[key] == ids["_id"]
    return df.join(ids, cond, "left_semi"), df.join(ids, cond, "left_anti")


def _known(ids: DataFrame) -> DataFrame:
    """``ids`` without nulls, as a comparison (true for every value): the kind of
    predicate that makes a join side a source of a runtime filter."""
    kind = ids.schema["_id"].dataType.simpleString()
    if kind == "string":
        return ids.where(F.col("_id") >= F.lit(""))
    if kind in ("int", "bigint"):
        return ids.where(F.col("_id") >= F.lit(-(1 << (31 if kind == "int" else 63))).cast(kind))
    return ids.where(F.col("_id").isNotNull())


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(label)


def rebalance(df: DataFrame, label: str, seed: int, key: str = "userId") -> DataFrame:
    """Downsample the larger class to about the size of the smaller one.

    Every minority row is kept; a majority row is kept when
    ``bucket * n_major < n_minor * 2^32`` (exact integer test).  With one
    class the input is returned unchanged.  Rows with a null label belong to
    neither class and are kept.
    """
    keep = rebalance_condition(df, label, seed, key)
    return df if keep is None else df.where(keep)


def rebalance_condition(df: DataFrame, label: str, seed: int, key: str = "userId") -> Column | None:
    """The row test of :func:`rebalance` (``None``: every row is kept), for
    queries that tag the rebalanced rows inside a larger pass.

    The driver sees two aggregate rows: the least and largest label, then how
    many rows have them; any other label makes it not binary."""
    low, high = df.agg(F.min(label), F.max(label)).head()
    if low is None or low == high:
        return None
    n_low, n_high, n = df.agg(F.count_if(F.col(label) == F.lit(low)), F.count_if(F.col(label) == F.lit(high)),
                              F.count(label)).head()
    if n_low + n_high != n:
        raise ValueError(f"{label} is not binary")
    if n_low == n_high:
        return None
    minor_val, n_minor, n_major = (low, n_low, n_high) if n_low < n_high else (high, n_high, n_low)
    bucket = hash_unit(key, seed).cast("decimal(38,0)")
    keep_major = bucket * F.lit(n_major).cast("decimal(38,0)") < F.lit(n_minor * TWO_32).cast("decimal(38,0)")
    return F.col(label).isNull() | (F.col(label) == F.lit(minor_val)) | keep_major
