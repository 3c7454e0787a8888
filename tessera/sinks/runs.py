"""K1 K2 K7 K8: every run of a job writes into a folder of its own, and is
announced by one manifest row once all of it is written.

A run that fails, at whatever step, leaves the announced one as it was. Readers
ask ``current_run`` for the last run announced; folders that later runs have
replaced are removed after the announcement.
"""

from __future__ import annotations

import datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .publish import MANIFEST_SCHEMA

CLAIM = "_claimed"


def landed_name(table_name: str) -> str:
    """Fixed value: how a landed table is named."""
    return f"{table_name.upper()}_LANDED"


def _fs(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    where = hadoop.Path(path)
    return hadoop, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    _, fs, path = _fs(spark, folder)
    if not fs.exists(path):
        return []
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(path) if s.isDirectory() and s.getPath().getName().isdigit())


def claim_run(spark: SparkSession, folder: str) -> int:
    """The next run number under ``folder``, taken for the caller alone: the
    claim file is made only where none is, so two jobs never share a folder."""
    hadoop, fs, _ = _fs(spark, folder)
    number = max(_numbers(spark, folder), default=0)
    while True:
        number += 1
        try:
            fs.create(hadoop.Path(f"{folder}/{number}/{CLAIM}"), False).close()
            return number
        except Exception:
            if not fs.exists(hadoop.Path(f"{folder}/{number}/{CLAIM}")):
                raise


def announced_runs(spark: SparkSession, manifest_path: str, table_name: str) -> list[int]:
    """Numbers of the runs of a table that the manifest announces, ascending."""
    _, fs, path = _fs(spark, manifest_path)
    if not fs.exists(path):
        return []
    rows = (spark.read.schema(MANIFEST_SCHEMA).parquet(manifest_path)
            .where((F.col("table_name") == landed_name(table_name)) & F.col("run").isNotNull()).select("run").distinct())
    return sorted(r.run for r in rows.collect())


def current_run(spark: SparkSession, manifest_path: str, table_name: str) -> int | None:
    """The run that readers use: the highest one announced."""
    return max(announced_runs(spark, manifest_path, table_name), default=None)


def prune_runs(spark: SparkSession, folder: str, announced: list[int], keep: int) -> list[int]:
    """Remove the folders below the last ``keep`` announced runs (failed runs
    among them too); a run still being written has a higher number."""
    kept = announced[-max(keep, 1):]
    gone = [n for n in _numbers(spark, folder) if kept and n < kept[0]]
    hadoop, fs, _ = _fs(spark, folder)
    for n in gone:
        fs.delete(hadoop.Path(f"{folder}/{n}"), True)
    return gone


def announce(spark: SparkSession, manifest_path: str, *, table_name: str, order_date: str, run: int,
             output_path: str, loaded: int, exceptions: int, rejects: int, landed_at: str | None = None) -> None:
    """K7: record that ``<TABLE>`` landed, after all its data was written: one
    appended row, which turns readers to the new run."""
    landed_at = landed_at or datetime.datetime.now().strftime("%Y-%m-%d %H:%M:%S")
    row = [(landed_name(table_name), order_date, output_path, loaded, exceptions, rejects, landed_at, run)]
    spark.createDataFrame(row, MANIFEST_SCHEMA).coalesce(1).write.mode("append").parquet(manifest_path)
