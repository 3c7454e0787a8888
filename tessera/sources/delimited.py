"""Delimited tables read as all-string columns with a header row."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import base_name, column, decode_path
from .records import read_heads, read_records

SUPPORTED_FILE_TYPES = ("csv",)
PIPE = "|"
SOURCE_COLUMNS = ("_source_path", "_source_name")


def _check_type(file_type: str) -> None:
    if file_type not in SUPPORTED_FILE_TYPES:
        raise RuntimeError(f"cannot read {file_type!r} files, only {', '.join(SUPPORTED_FILE_TYPES)}")


def _with_source(df: DataFrame) -> DataFrame:
    p = decode_path(F.col("_metadata.file_path"))
    path, name = SOURCE_COLUMNS
    return df.select("*", p.alias(path), base_name(p).alias(name))


def _empty_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.coalesce(column(c), F.lit("")).alias(c) if t == "string" and c not in SOURCE_COLUMNS else column(c)
                       for c, t in df.dtypes])


def _csv_options(delimiter: str) -> dict[str, str]:
    return {"sep": delimiter, "quote": '"', "escape": '"', "multiLine": "true", "mode": "FAILFAST"}


def _partition_names(files: list[str], root: str) -> list[str]:
    """Names of the folders ``name=value`` between ``root`` and the files."""
    below = {tuple(part.partition("=")[0] for part in f.rpartition(root)[2].split("/")[:-1] if "=" in part) for f in files}
    if len(below) > 1:
        raise ValueError(f"files under {root} lie in folders of different names: {sorted(below)}")
    return list(below.pop()) if below else []


def _records_as_columns(spark: SparkSession, files: list[str], header: tuple[str, ...], delimiter: str, root: str | None = None) -> DataFrame:
    """Files of one header, whose quoted fields may hold line breaks, by many
    tasks a file. Folders ``name=value`` below ``root`` are columns, too."""
    records = read_records(spark, [_literal_path(f) for f in files], delimiter).where(~F.col("first"))
    path, name = SOURCE_COLUMNS
    parsed = records.select(F.from_csv("record", _ddl(header), _csv_options(delimiter)).alias("_row"), "file_path")
    folders = []
    for n in _partition_names(files, root.rstrip("/") + "/") if root is not None else []:
        value = F.regexp_extract("file_path", f"/{re.escape(n)}=([^/]*)/", 1)
        folders.append(F.when(value != "__HIVE_DEFAULT_PARTITION__", value).alias(n))
    return parsed.select(*(F.col("_row").getField(c).alias(c) for c in header), *folders, F.col("file_path").alias(path),
                         base_name(F.col("file_path")).alias(name))


def _ddl(names: tuple[str, ...]) -> str:
    return ", ".join("`" + c.replace("`", "``") + "` string" for c in names)


def _literal_path(path: str) -> str:
    """A path that Spark takes as one file: glob characters escaped."""
    return "".join("\\" + c if c in "\\*?[]{}" else c for c in path)


def read_delimited(spark: SparkSession, path: str | list[str], file_type: str = "csv",
                   delimiter: str = ",", with_source: bool = False,
                   empty_as_null: bool = True, multi_line: bool = False) -> DataFrame:
    """Header row, caller's delimiter, every column a string (no inference).

    All files must have the same header; one that differs is an error, as its
    values would land in other columns. ``with_source=True`` adds
    ``_source_path`` and ``_source_name``; ``empty_as_null=False`` reads empty
    fields as ``''`` like a plain CSV reader. ``multi_line=True`` takes line
    breaks in quoted fields (a doubled quote stands for one); a large file is
    still read by many tasks.
    """
    _check_type(file_type)
    if multi_line:
        found = headers(spark, path, delimiter)
        if len(found) != 1:
            raise ValueError(f"files under {path} have {len(found)} different headers")
        (header, files), = found.items()
        df = _records_as_columns(spark, files, header, delimiter)
        df = df if with_source else df.drop(*SOURCE_COLUMNS)
        return df if empty_as_null else _empty_text(df)
    df = (spark.read.option("header", "true").option("sep", delimiter).option("enforceSchema", "false")
          .option("inferSchema", "false").csv(path))
    if with_source:
        df = _with_source(df)
    return df if empty_as_null else _empty_text(df)


def headers(spark: SparkSession, path: str | list[str], delimiter: str) -> dict[tuple[str, ...], list[str]]:
    """Files by their header, the fields of the first record. Only the heads of
    files are read; a file without a record has no rows."""
    found: dict[tuple[str, ...], list[str]] = {}
    for file, head in read_heads(spark, path, delimiter):
        header = tuple(next(csv.reader(head.splitlines(keepends=True), delimiter=delimiter), ()))
        if len(set(header)) < len(header) or not all(header):
            raise ValueError(f"header {head!r} of {file} has an empty or repeated name")
        found.setdefault(header, []).append(file)
    return found


def read_pipe_directory(spark: SparkSession, directory: str, *, multi_line: bool = True, split: bool = True) -> Iterator[DataFrame]:
    """The pipe-delimited files of a folder, one DataFrame per distinct
    header, with ``_source_path`` and ``_source_name``.

    Fields may be quoted (a doubled quote stands for one), hold line breaks and
    blanks at either end; empty fields are ``''``. A row with more or fewer
    fields than its header is an error. A large file is read by many tasks
    (``records.read_records``); ``multi_line=False`` saves the search for quoted
    line breaks in folders without any, and ``split=False`` reads every file
    whole, in one task, as files with bare CR line ends need it.
    """
    for header, files in headers(spark, directory, PIPE).items():
        if multi_line and split:
            yield _empty_text(_records_as_columns(spark, files, header, PIPE, directory))
            continue
        schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
        df = (spark.read.schema(schema).option("header", "true").option("basePath", directory).options(**_csv_options(PIPE))
              .option("multiLine", str(multi_line).lower()).option("columnPruning", "false").csv([_literal_path(f) for f in files]))
        yield _empty_text(_with_source(df))
