"""Job B end to end: mask delimited files by column type, or a folder of pipe files by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import column
from ..operators.mask import apply_mask_config, keyed_mask
from ..sinks.publish import redated_name, write_delimited
from ..sources.config import load_mask_config, load_mask_spec
from ..sources.delimited import PIPE, SOURCE_COLUMNS, read_delimited, read_pipe_directory


def run_mask_job(spark: SparkSession, input_path: str, output_path: str, config_path: str,
                 file_type: str = "csv", delimiter: str = ",", *, salt: str,
                 key_columns: dict[str, list[str]] | None = None) -> DataFrame:
    """S8 + S7 + V1-V3 + M15 + K9: mask the configured columns and write the table.

    ``key_columns`` names, per masked column, the columns whose values choose
    the replacement (e.g. a row's id, so that equal values of different rows
    get different replacements); by default it is the column's own value.
    """
    config = load_mask_config(spark, config_path)
    df = read_delimited(spark, input_path, file_type, delimiter)
    masked = apply_mask_config(df, config, salt=salt, key_columns=key_columns)
    write_delimited(masked, output_path, file_type, delimiter)
    return masked


def mask_pipe_files(df: DataFrame, spec: dict, test_date: str | None = None, *, salt: str) -> DataFrame:
    """M16-M19 + K10 over rows read by ``read_pipe_directory``: masked data
    columns plus ``target_name``, the re-dated output name of each row's file."""
    masked = keyed_mask(df, spec, salt=salt, passthrough=SOURCE_COLUMNS)
    data_cols = [column(c) for c in df.columns if c not in SOURCE_COLUMNS]
    return masked.select(*data_cols, redated_name(F.col("_source_name"), test_date).alias("target_name"))


def run_keyed_mask_dir(spark: SparkSession, source_dir: str, target_dir: str, spec_path: str,
                       test_date: str | None = None, *, salt: str, multi_line: bool = True) -> int:
    """S9 + S10 + M16-M19 + K9 + K10: every pipe-delimited file of a folder,
    masked by key under its own header, written under
    ``target_dir/target_name=<re-dated name>/`` (one folder per source file,
    header in every part). The spec is checked against every header before
    anything is written. Returns the number of distinct headers."""
    spec = load_mask_spec(spark, spec_path)
    outs = [mask_pipe_files(df, spec, test_date, salt=salt)
            for df in read_pipe_directory(spark, source_dir, multi_line=multi_line)]
    for k, out in enumerate(outs):
        write_delimited(out, target_dir, "csv", PIPE, partition_by="target_name", quote_empty=False,
                        mode="append" if k else "overwrite")
    return len(outs)
