"""Typed table, exceptions, headers, width rejects, summary, delimited output.

A run writes into its own folder (``runs.py``; K8: readers are turned to the new
run as a whole, also when it has no rows), the shared header files are written
once (``ignore``). Within a folder, a write replaces what is there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _sized(df: DataFrame, num_files: int | None) -> DataFrame:
    """Fix the number of output files without starving the upstream stage.

    ``coalesce(n)`` would run the whole parse in n tasks; ``repartition(n)``
    keeps the scan parallel and only shuffles the finished rows.
    """
    if num_files is None:
        return df
    return df.repartition(int(num_files))


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row count that is filled in by the write itself (no extra job)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def write_parquet(df: DataFrame, path: str, num_files: int | None = None,
                  max_records_per_file: int | None = None) -> int:
    """K1/K2: Parquet, overwrite; returns the number of rows written.

    ``num_files`` fixes the file count with a shuffle of the rows; at large
    scale prefer ``max_records_per_file``, which bounds file size with no
    shuffle (each task splits its output)."""
    # counted after the shuffle: a map task run again must not count twice
    df, obs = observed(_sized(df, num_files), "parquet_rows")
    w = df.write.mode("overwrite")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    w.parquet(path)
    return int(obs.get["rows"])


def write_csv_detail(df: DataFrame, path: str, num_files: int | None = None, sep: str = ",") -> int:
    """K3/K6: headerless CSV, overwrite; returns rows written."""
    df, obs = observed(_sized(df, num_files), "csv_rows")
    (df.write.mode("overwrite").option("header", "false")
     .option("sep", sep).csv(path))
    return int(obs.get["rows"])


def header_frame(spark: SparkSession, columns: list[str]) -> DataFrame:
    """One row whose values are the column names."""
    return spark.range(1).select(*[F.lit(c).alias(c) for c in columns])


def write_header(spark: SparkSession, columns: list[str], path: str) -> None:
    """K4: the shared header row as one CSV file, written only if absent."""
    header_frame(spark, columns).coalesce(1).write.mode("ignore").option("header", "false").csv(path)


def write_text(df: DataFrame, path: str, num_files: int | None = None) -> int:
    """K5: the ``value`` column as text lines, overwrite; returns rows written."""
    df, obs = observed(_sized(df.select("value"), num_files), "text_rows")
    df.write.mode("overwrite").text(path)
    return int(obs.get["rows"])


MANIFEST_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("order_date", T.StringType()),
    T.StructField("output_path", T.StringType()),
    T.StructField("loaded_count", T.LongType()),
    T.StructField("exception_count", T.LongType()),
    T.StructField("reject_count", T.LongType()),
    T.StructField("landed_at", T.StringType()),
    T.StructField("run", T.LongType()),
])


def write_delimited(df: DataFrame, path: str, file_type: str = "csv", delimiter: str = ",",
                    partition_by: str | None = None, quote_empty: bool = True, mode: str = "overwrite") -> None:
    """K9: delimited text with a header row.

    ``partition_by`` writes one folder per value of that column (used for
    per-source-file output, S10/K10); ``quote_empty=False`` writes empty
    strings as nothing, like a plain CSV writer."""
    if file_type != "csv":
        raise RuntimeError(f"File type {file_type!r} is not supported; only csv is")
    w = df.write.mode(mode).option("header", "true").option("sep", delimiter)
    # a quote within a field is doubled, blanks at its ends are kept
    w = w.option("escape", '"').option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
    if not quote_empty:
        w = w.option("emptyValue", "")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.csv(path)


def redated_name(name: Column, test_date: str | None) -> Column:
    """Replace the last ``_`` token of the stem with ``test_date`` (one dot
    before the suffix)."""
    if not test_date:
        return name
    has_dot = F.contains(name, F.lit("."))
    stem = F.when(has_dot, F.regexp_extract(name, r"^(.*)\.[^.]*$", 1)).otherwise(name)
    suffix = F.when(has_dot, F.regexp_extract(name, r"(\.[^.]*)$", 1)).otherwise(F.lit(""))
    head = F.regexp_extract(stem, r"^(.*)_[^_]*$", 1)
    return F.concat(head, F.lit(f"_{test_date}"), suffix)
