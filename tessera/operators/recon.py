"""Counts and the per-file reconciliation summary: A1-A6, J1-J3, W1, W2, O1-O3, R1-R3, P10.

All inputs here are per-file aggregates (one row per source file) or the
marker file (one line per source file), so the joins and single-partition
windows in this module run on a few rows per file, never on record-level data.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import base_name
from .numbering import number_rows, number_split_lines

# The summary's columns, in order.
SUMMARY_COLUMNS = ("table_name", "file_name", "order_date", "job_run_date",
                   "source_file_record_count", "record_length_rejection_count",
                   "total_records_loaded_count", "clean_record_count",
                   "data_quality_issue_count", "number_of_source_files")

# Fixed value: the marker count is the digits after the first colon of a line.
MARKER_COUNT_REGEX = r":\s*(\d+)"
#: The file a marker line speaks of: all before its first colon.
MARKER_NAME_REGEX = r"^([^:]*)"

FILES_PER_BLOCK = 10_000


def run_counts(per_file: DataFrame, inventory: DataFrame | None = None) -> DataFrame:
    """A1 + A2 + A6 as one row, aggregated from per-file rows.

    ``per_file`` comes from ``Parsed.file_counts`` (``file_path, raw_count,
    loaded_count, dq_error_count, dq_row_count``); with an ``inventory`` the
    listed files are left-joined first so listed-but-empty files are counted,
    without one the files are those that have rows.
    """
    rows = per_file
    if inventory is not None:
        rows = inventory.select("file_path").join(per_file, "file_path", "left")
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    aggs = [
        F.sum(z("raw_count")).cast("long").alias("raw_count"),
        F.sum(z("loaded_count")).cast("long").alias("loaded_count"),
        F.sum(z("raw_count") - z("loaded_count")).cast("long").alias("rejected_count"),
        F.sum(z("dq_error_count")).cast("long").alias("dq_error_count"),
        F.sum(z("dq_row_count")).cast("long").alias("dq_row_count"),
        F.count_if(z("raw_count") > 0).cast("long").alias("files_with_rows"),
    ]
    aggs.append(F.count(F.lit(1)).cast("long").alias("number_of_source_files"))
    return rows.agg(*aggs)


def marker_counts(lines: DataFrame, order: Column | None = None,
                  value_col: str = "value", per_file: str | None = None, single_file: bool = False) -> DataFrame:
    """S6 + W1 + O2: number marker lines and read the count after ``:``.

    ``lines`` come from ``numbering.read_split_lines`` and are numbered within
    their file (``per_file``, its path column, is kept), or, if no file is
    named, through all files in the order of their paths (``single_file``: there
    is one); any other rows are numbered by ``order``. Returns ``line_number, line_content, count`` (count
    null when a line has no digits). No step sorts or holds all lines in a task.
    """
    if order is not None:
        numbered = number_rows(lines, [order])
    else:
        numbered = number_split_lines(lines)
        if per_file is None and not single_file:
            files = lines.groupBy("file_path").agg(F.count(F.lit(1)).alias("_lines"))
            # one row per marker file: running totals over the files before it
            placed = number_rows(files, [F.col("file_path")], "_place")
            numbered = numbered.join(_lines_before(placed), "file_path").withColumn("line_number", F.col("line_number") + F.col("_lines_before"))
    keep = [] if per_file is None else [F.col("file_path").alias(per_file)]
    return (numbered.select(*keep, "line_number", F.col(value_col).alias("line_content"))
            .select("*", F.regexp_extract("line_content", MARKER_COUNT_REGEX, 1).try_cast("bigint").alias("count"))
            .orderBy(*([] if per_file is None else [per_file]), "line_number"))


def _lines_before(files: DataFrame) -> DataFrame:
    """``file_path, _lines_before``: lines of the files of smaller ``_place``.

    Files are taken in blocks of places; a block's total is added to all later
    blocks, a file's lines to the later files of its block.
    """
    block = F.floor(F.col("_place") / FILES_PER_BLOCK)
    files = files.withColumn("_block", block)
    within = Window.partitionBy("_block").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    totals = files.groupBy("_block").agg(F.sum("_lines").alias("_total"))
    upto = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)  # one row per FILES_PER_BLOCK marker files
    starts = totals.select("_block", F.coalesce(F.sum("_total").over(upto), F.lit(0)).alias("_start"))
    return (files.withColumn("_own", F.coalesce(F.sum("_lines").over(within), F.lit(0))).join(starts, "_block")
            .select("file_path", (F.col("_start") + F.col("_own")).alias("_lines_before")))


def marker_by_name(marker: DataFrame) -> DataFrame:
    """J3 by name: the files that marker lines (``line_number, line_content,
    count``) speak of: ``file_name`` (what stands before the colon, without
    blanks and folders), ``n_lines``, ``first_line``, ``source_count`` (null
    unless the file has just one line)."""
    name = base_name(F.trim(F.regexp_extract("line_content", MARKER_NAME_REGEX, 1)))
    return (marker.select(name.alias("file_name"), "line_number", "count").groupBy("file_name")
            .agg(F.count(F.lit(1)).alias("n_lines"), F.min("line_number").alias("first_line"), F.max("count").alias("only"))
            .select("file_name", "n_lines", "first_line", F.when(F.col("n_lines") == 1, F.col("only")).alias("source_count")))


def marker_problems(inventory: DataFrame, marker: DataFrame) -> DataFrame:
    """What keeps files and marker lines from being matched by name:
    ``file_name, problem, n_files, n_lines``, one row per name with a problem."""
    files = inventory.groupBy("file_name").agg(F.count(F.lit(1)).alias("n_files"))
    both = files.join(marker_by_name(marker), "file_name", "full").select(
        "file_name", F.coalesce("n_files", F.lit(0)).alias("n_files"), F.coalesce("n_lines", F.lit(0)).alias("n_lines"), "source_count")
    problem = (F.when(F.col("n_files") == 0, F.lit("no such file")).when(F.col("n_lines") == 0, F.lit("no marker line"))
               .when(F.col("n_lines") > 1, F.lit("several marker lines")).when(F.col("n_files") > 1, F.lit("several files"))
               .when(F.col("source_count").isNull(), F.lit("no count")))
    return both.select("file_name", problem.alias("problem"), "n_files", "n_lines").where("problem is not null")


def iso_order_date(order_date: str) -> str:
    """P10: ``YYYYMMDD`` -> ``YYYY-MM-DD`` (validated)."""
    return datetime.datetime.strptime(order_date, "%Y%m%d").strftime("%Y-%m-%d")


def job_timestamp(now: datetime.datetime | None = None) -> str:
    """P10: job run time as ``yyyy-MM-dd HH:mm:ss``."""
    return (now or datetime.datetime.now()).strftime("%Y-%m-%d %H:%M:%S")


def join_counts(per_file: DataFrame, dq_per_file: DataFrame) -> DataFrame:
    """Loaded counts left-join failing-row counts on the file (missing -> 0)."""
    return (per_file.join(dq_per_file.select("file_path", F.col("dq_count").alias("_dq")), "file_path", "left")
            .withColumn("dq_count", F.coalesce(F.col("_dq"), F.lit(0))).drop("_dq"))


def file_summary(inventory: DataFrame, per_file: DataFrame, dq_per_file: DataFrame | None, *,
                 table_name: str, order_date: str, job_run_date: str,
                 marker: DataFrame | None = None,
                 per_file_rejects: bool = False,
                 join_on: str = "path", match: str = "order") -> DataFrame:
    """One row per listed file, sorted by file name.

    * J1: loaded counts left-join failing-row counts (missing -> 0); pass
      ``dq_per_file=None`` when ``per_file`` already has ``dq_count`` (as
      ``Parsed.file_counts`` computes both in one aggregation).
    * J2: the file inventory left-joins that, so a listed file without good
      rows shows zeros and unlisted files drop out.
    * With ``marker`` (``line_number, count``): J3 matches the n-th file by name
      with the n-th marker line; R2 returns no rows when the number of marker
      lines differs from the number of files (see ``marker_mismatch``).
    * ``match='name'`` matches marker lines by the file name they begin with
      instead, in whatever order they stand. A file without a line of its own
      has null counts; ``marker_problems`` reports it, and lines without a file.
    * Without a marker (R3) the source count is null and the rejection count is
      the run's total width rejects on every row (``per_file_rejects=True``
      gives each file its own).

    ``join_on='path'`` joins on the full path (equal names in two folders stay
    apart); ``'name'`` joins on the base name like the reference.
    """
    key = "file_path" if join_on == "path" else "file_name"
    if join_on not in ("path", "name"):
        raise ValueError("join_on must be 'path' or 'name'")
    if match not in ("order", "name"):
        raise ValueError("match must be 'order' or 'name'")

    def keyed(df: DataFrame) -> DataFrame:
        return df if key == "file_path" else df.withColumn("file_name", base_name(F.col("file_path"))).drop("file_path")

    counts = per_file if dq_per_file is None else join_counts(per_file, dq_per_file)       # J1
    stats = keyed(counts).groupBy(key).agg(F.sum("raw_count").alias("raw_count"),
                                           F.sum("loaded_count").alias("loaded_count"),
                                           F.sum("dq_count").alias("dq_count")) \
        if key == "file_name" else counts.select(key, "raw_count", "loaded_count", "dq_count")
    inv = inventory.select("file_path", "file_name")
    base = (inv.join(stats, key, "left")                                              # J2
            .select("file_path", "file_name", "raw_count",
                    F.coalesce("loaded_count", F.lit(0)).alias("loaded"),
                    F.coalesce("dq_count", F.lit(0)).alias("dq")))
    everything = Window.partitionBy()
    base = base.withColumn("n_files", F.count(F.lit(1)).over(everything))

    if marker is not None and match == "name":
        rows = (base.withColumn("n_same", F.count(F.lit(1)).over(Window.partitionBy("file_name")))
                .join(marker_by_name(marker), "file_name", "left"))
        source = F.when(F.col("n_same") == 1, F.col("source_count"))
        rejects = source - F.col("loaded")
    elif marker is not None:
        ordered = base.withColumn(                                                     # W2
            "ordinal", F.row_number().over(Window.orderBy("file_name", "file_path")))
        m = marker.select(F.col("line_number"), F.col("count").alias("source_count"))
        joined = (ordered.join(m, ordered["ordinal"] == m["line_number"], "full")      # J3
                  .withColumn("n_lines", F.count("line_number").over(everything))
                  .withColumn("n_rows", F.count("file_name").over(everything)))
        rows = joined.where(F.col("file_name").isNotNull() & (F.col("n_rows") == F.col("n_lines")))
        source = F.col("source_count")
        rejects = source - F.col("loaded")
    else:
        rows = base
        source = F.lit(None).cast("bigint")
        if per_file_rejects:
            rejects = F.coalesce(F.col("raw_count"), F.lit(0)) - F.col("loaded")
        else:
            rejects = F.sum(F.coalesce(F.col("raw_count"), F.lit(0)) - F.col("loaded")).over(everything)

    return (rows.select(
                F.lit(table_name).alias("table_name"),
                F.col("file_name"),
                F.lit(iso_order_date(order_date)).alias("order_date"),
                F.lit(job_run_date).alias("job_run_date"),
                source.cast("bigint").alias("source_file_record_count"),
                rejects.cast("bigint").alias("record_length_rejection_count"),
                F.col("loaded").cast("bigint").alias("total_records_loaded_count"),
                (F.col("loaded") - F.col("dq")).cast("bigint").alias("clean_record_count"),
                F.col("dq").cast("bigint").alias("data_quality_issue_count"),
                F.col("n_files").cast("bigint").alias("number_of_source_files"))
            .orderBy("file_name"))                                                      # O1


def marker_mismatch(inventory: DataFrame, marker: DataFrame) -> tuple[int, int]:
    """R2 check for jobs: (number of files, number of marker lines)."""
    return inventory.count(), marker.count()
