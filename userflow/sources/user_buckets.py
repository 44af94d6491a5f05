"""A log stored by user, so that aggregates and joins on the user need no shuffle.

Rows are bucketed by a hash of the user into a table; queries that group or join
on the user (and anything beside it) read their buckets in place.  A user with a
large share of the rows would make one bucket, and so one task, large: users over
a stated number of rows, and rows without a user, go to a second, plain table,
which is read by the ordinary shuffling path (map-side aggregates, split skewed
joins).  Results of the two are simply put together, since no user is in both.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from userflow.session import materialize, shared_path

#: Rows from which a user's rows are kept out of the buckets.
HOT_ROWS = 5_000_000

# Joins on (user, something) of two sides bucketed by user: the user alone
# already brings matching rows together.
_CO_LOCATED = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


@dataclass(frozen=True)
class UserBuckets:
    """Names of the two tables of a log stored by user."""

    table: str
    hot_table: str
    buckets: int

    def parts(self, spark: SparkSession) -> tuple[DataFrame, DataFrame]:
        return spark.table(self.table), spark.table(self.hot_table)


def store_by_user(log: DataFrame, table: str, buckets: int, hot_rows: int = HOT_ROWS, path: str | None = None) -> UserBuckets:
    """Write ``log`` as ``table`` (bucketed by ``userId``) and ``<table>_hot`` (users
    with more than ``hot_rows`` rows, rows without a user), replacing both.

    ``buckets`` should give files of 128 - 256 MB.  The list of hot users has at
    most ``rows / hot_rows`` entries."""
    spark = log.sparkSession
    path = path or shared_path(spark, "user_tables")
    hot = materialize(log.where("userId is not null").groupBy("userId").agg(F.count("*").alias("_n"))
                      .where(F.col("_n") > int(hot_rows)).select(F.col("userId").alias("_hot")))
    match = F.col("userId") == F.col("_hot")
    even = log.where("userId is not null").join(hot, match, "left_anti")
    rest = log.where("userId is null").unionByName(log.join(hot, match, "left_semi"))
    # Dealt out as the buckets are, so that a bucket is one file.
    (even.repartition(buckets, "userId").write.mode("overwrite").option("path", f"{path}/even")
     .bucketBy(buckets, "userId").format("parquet").saveAsTable(table))
    rest.write.mode("overwrite").option("path", f"{path}/hot").format("parquet").saveAsTable(f"{table}_hot")
    return UserBuckets(table, f"{table}_hot", buckets)


@contextmanager
def co_located(spark: SparkSession) -> Iterator[None]:
    """Plans made (and run) inside join bucketed sides without an exchange."""
    before = {k: spark.conf.get(k, None) for k in _CO_LOCATED}
    for k, v in _CO_LOCATED.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def by_user(spark: SparkSession, stored: UserBuckets, build: Callable[[DataFrame, bool], DataFrame]) -> DataFrame:
    """``build(log, known_users)`` for the two tables of a log stored by user, the
    first of which (``known_users``) is written once: ``build`` must keep users apart
    (group and join by the user, perhaps with more)."""
    even, hot = stored.parts(spark)
    with co_located(spark):
        ready = materialize(build(even, True))
    return ready.unionByName(build(hot, False))
