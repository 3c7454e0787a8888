"""Text records with their source path, file inventories, marker files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import base_name, decode_path
from ..operators.numbering import read_split_lines
from ..operators.recon import marker_counts

INVENTORY_SCHEMA = T.StructType([T.StructField("file_path", T.StringType()),
                                 T.StructField("file_name", T.StringType())])


def read_lines(spark: SparkSession, paths: str | list[str], line_sep: str | None = None) -> DataFrame:
    """S1 + S2: one row per text line, ``value, file_path`` (decoded path).

    ``line_sep`` fixes the record separator when records may hold a stray CR.
    """
    reader = spark.read
    if line_sep is not None:
        reader = reader.option("lineSep", line_sep)
    df = reader.text(paths if isinstance(paths, list) else [paths])
    return df.select("value", decode_path(F.col("_metadata.file_path")).alias("file_path"))


_GLOB_SPECIALS = set("\\*?[]{}")


def prefix_glob(file_prefix: str | None) -> str | None:
    """Glob matching base names that start with ``file_prefix`` (specials escaped)."""
    if not file_prefix:
        return None
    return "".join("\\" + c if c in _GLOB_SPECIALS else c for c in file_prefix) + "*"


def _reader(spark: SparkSession, file_prefix: str | None, line_sep: str | None = None):
    reader = spark.read
    glob = prefix_glob(file_prefix)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if line_sep is not None:
        reader = reader.option("lineSep", line_sep)
    return reader


def read_dir_lines(spark: SparkSession, directory: str, file_prefix: str | None = None,
                   line_sep: str | None = None) -> DataFrame:
    """S1 + S2 over a folder, only files whose name starts with ``file_prefix``.

    The name filter is applied by Spark's file listing, so other files are
    never opened and no file list passes through the driver.
    """
    df = _reader(spark, file_prefix, line_sep).text(directory)
    return df.select("value", decode_path(F.col("_metadata.file_path")).alias("file_path"))


def list_files(spark: SparkSession, path: str, file_prefix: str | None = None) -> DataFrame:
    """S5 + A6: files under ``path`` whose base name starts with ``file_prefix``
    (dots kept): ``file_path, file_name``. Empty files are listed too.

    The listing is file metadata from Spark's file index (one row per file,
    not per record), so it is built on the driver like Spark's own planning.
    """
    files = _reader(spark, file_prefix).text(path).inputFiles()
    inv = spark.createDataFrame([(f,) for f in sorted(files)], "file_path string")
    inv = inv.select(decode_path(F.col("file_path")).alias("file_path"))
    return inv.select("file_path", base_name(F.col("file_path")).alias("file_name"))


def read_marker(spark: SparkSession, path: str, per_file: bool = False) -> DataFrame:
    """S6 + W1: ``line_number, line_content, count`` of a control-count file.

    Lines are numbered by their place in the file, whatever splits Spark reads
    it in; the files of a folder follow each other in the order of their paths.
    ``per_file=True`` numbers each file's lines separately (``file_path`` kept).
    """
    single = len(spark.read.text(path).inputFiles()) == 1
    return marker_counts(read_split_lines(spark, path), per_file="file_path" if per_file else None, single_file=single)
