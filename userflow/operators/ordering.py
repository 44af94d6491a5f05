"""Position of a row inside its group, without sorting a whole group in one task.

``row_number() over (partition by g order by o)`` sorts each group inside a
single task, so one group holding a third of the log would run in one task.
Here a group is cut into sub-groups by a ``split`` column that is monotone in
the ordering (for example the minute of ``ts``).  Each row is numbered inside
its sub-group, and a count table with one row per (group, sub-group) supplies
how many rows of the group sit in earlier sub-groups.  The windows therefore
see one sub-group, or the bounded count rows of one group, at a time, and the
result depends only on the data, not on how tasks were laid out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def position_in_group(df: DataFrame, group_cols: list[str], order_cols: list[str], out: str,
                      split: Column) -> DataFrame:
    """Add ``out`` = 0-based position of each row in its group ordered by ``order_cols``.

    ``split`` must be non-decreasing along ``order_cols`` within a group.
    Equal to ``row_number() - 1``; rows tied on the whole key share their
    positions in an unspecified order, as with row_number.
    """
    keys = [*group_cols, "_split"]
    d = df.withColumn("_split", split)
    ranked = d.withColumn(
        "_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order_cols)) - 1
    )
    # counted from the input with a map-side partial count, so only one row
    # per sub-group and task is shuffled (Spark does not reuse the ranked
    # side's shuffle for a second branch; counting from it shuffles the raw
    # rows twice)
    counts = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*group_cols).orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
    )
    cond = reduce(lambda a, b: a & b, [ranked[k].eqNullSafe(before[f"_k{i}"]) for i, k in enumerate(keys)])
    joined = ranked.join(before, cond, "inner")
    pos = (F.col("_r") + F.col("_before")).cast("long").alias(out)
    return joined.select(*[F.col(c) for c in df.columns], pos)
