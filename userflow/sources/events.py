"""Reader and writer of the activity log.

The log is read with the declared :data:`EVENTS` schema: no inference pass over
the input, and a ``length`` that is a whole number in the first rows cannot
turn the column into a long.  Nothing is lost unseen: a line that does not
parse, a field of another type or a missing timestamp fails the job, or is kept
beside its original text on request; a columnar file must have the declared
columns before they are imposed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from userflow.functions.columns import floor_div
from userflow.sources.schema import DAY_MS, EVENTS, check_schema

BAD_LINE = "_bad_line"
#: Files that one day's rows are dealt over (by user) when a log is written.
FILES_PER_DAY = 8


def load_activity(spark: SparkSession, path: str | list[str], fmt: str = "json", bad_lines: str = "fail") -> DataFrame:
    """Read an activity log in ``json`` (one object per line), ``parquet`` or ``orc``.

    Filters and projections placed on the result reach the scan: parquet and
    ORC push ``ts`` / ``userId`` predicates into the reader and read only the
    columns used downstream.

    JSON: ``bad_lines='fail'`` stops at a line that does not parse, has a field
    of another type or no ``ts``; ``'keep'`` returns such lines as rows with the
    line in column ``_bad_line`` (null for good rows; a row without ``ts`` has an
    empty string there), see :func:`count_bad_lines`.
    """
    if fmt in ("parquet", "orc"):
        check_schema(spark.read.format(fmt).load(path))  # what the files hold, before it is imposed
        return spark.read.schema(EVENTS).format(fmt).load(path)
    if fmt != "json":
        raise ValueError(f"unsupported format {fmt!r}")
    if bad_lines == "fail":
        df = spark.read.schema(EVENTS).option("mode", "FAILFAST").json(path)
        seen = F.coalesce("ts", F.raise_error(F.lit("a log line has no ts")).cast("long"))
        return df.withColumn("ts", seen)
    if bad_lines != "keep":
        raise ValueError(f"bad_lines is 'fail' or 'keep', not {bad_lines!r}")
    schema = T.StructType([*EVENTS.fields, T.StructField(BAD_LINE, T.StringType())])
    df = spark.read.schema(schema).option("columnNameOfCorruptRecord", BAD_LINE).json(path)
    return df.withColumn(BAD_LINE, F.when(F.col("ts").isNull(), F.coalesce(BAD_LINE, F.lit(""))).otherwise(F.col(BAD_LINE)))


def count_bad_lines(df: DataFrame) -> int:
    """Bad lines of a log read with ``bad_lines='keep'``."""
    return df.agg(F.count(BAD_LINE)).head()[0]


def write_activity(df: DataFrame, path: str, partition_by_day: bool = True, mode: str = "append",
                   files_per_day: int = FILES_PER_DAY) -> None:
    """Store a log as parquet, partitioned by UTC day so time slices prune files.

    ``mode='append'`` adds the rows; ``'replace_days'`` replaces the days that
    ``df`` holds and leaves all others as they are; ``'replace_all'`` replaces the
    whole log.  Rows are dealt out by day and a bounded hash of the user, so a
    day has at most ``files_per_day`` new files and no day is one task.
    """
    modes = {"append": "append", "replace_days": "overwrite", "replace_all": "overwrite"}
    if mode not in modes or (mode == "replace_days" and not partition_by_day):
        raise ValueError(f"mode {mode!r} does not fit")
    if not partition_by_day:
        df.write.mode(modes[mode]).parquet(path)
        return
    out = df.withColumn("day", floor_div("ts", DAY_MS))
    out = out.repartition("day", F.pmod(F.xxhash64("userId"), F.lit(int(files_per_day))))
    (out.write.mode(modes[mode]).option("partitionOverwriteMode", "dynamic" if mode == "replace_days" else "static")
     .partitionBy("day").parquet(path))
