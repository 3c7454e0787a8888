"""Line numbers of text files and of ordered rows, without a window over all rows.

A Spark task sees the lines of one split of a file in order, so a line's number
is its place within its split plus the lines of the splits before. The counts
per split are the only thing that is ordered, file by file; the order in which
Spark deals splits to tasks has no say. Rows that are no files' lines are
numbered by range partitions in the same way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import decode_path
from ..session import saved

#: Columns of the places of lines: file, first byte of the split, and an id that
#: grows by one from line to line within a split.
SPLIT_COLUMNS = ("file_path", "_split", "_id")


def read_split_lines(spark: SparkSession, path: str | list[str], line_sep: str | None = None) -> DataFrame:
    """``value`` and ``SPLIT_COLUMNS`` of every line."""
    reader = spark.read if line_sep is None else spark.read.option("lineSep", line_sep)
    return reader.text(path).select("value", decode_path(F.col("_metadata.file_path")).alias("file_path"),
                                    F.col("_metadata.file_block_start").alias("_split"), F.monotonically_increasing_id().alias("_id"))


def number_split_lines(lines: DataFrame, name: str = "line_number") -> DataFrame:
    """``name``: the number (from 1) of each line of ``read_split_lines`` within its file.

    A split's lines are joined with one row; a file of any length is spread over
    its splits.
    """
    splits = lines.groupBy("file_path", "_split").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    before = Window.partitionBy("file_path").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select("file_path", "_split", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (lines.join(starts, ["file_path", "_split"])
            .withColumn(name, (F.col("_before") + F.col("_id") - F.col("_first") + 1).cast("long")).drop("_before", "_first"))


def number_rows(df: DataFrame, order: list[Column], name: str = "line_number") -> DataFrame:
    """``name``: the number (from 1) of each row in the order given.

    Rows are dealt by ranges of the order; every range counts its own rows, and
    starts from the total of the ranges before (one number per range reaches the
    driver). Rows of equal order are numbered in any order among each other.
    """
    keys = [f"_order{k}" for k in range(len(order))]
    ranged = df.select("*", *(c.alias(k) for c, k in zip(order, keys, strict=True))).repartitionByRange(*keys)
    placed = saved(ranged.withColumn("_range", F.spark_partition_id()), "numbering")  # the ranges are drawn from a sample: once
    counts = {r["_range"]: r["n"] for r in placed.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect()}
    total, starts = 0, []
    for part in range(max(counts, default=-1) + 1):
        starts.append(total)
        total += counts.get(part, 0)
    first = F.element_at(F.array(*(F.lit(n).cast("long") for n in starts or [0])), F.col("_range") + 1)
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*keys))
    return placed.withColumn(name, (first + within).cast("long")).drop("_range", *keys)
