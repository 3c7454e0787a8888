"""Job A on a landing folder as a Structured Streaming query.

The reference runs Job A as a batch over a folder. When a folder keeps
receiving files, the same parse runs on Spark's file stream source: each
micro-batch holds only new files, is parsed with ``parse_lines`` and written by
``foreachBatch``. Every output of a batch goes to its own ``batch=<id>`` folder
with ``overwrite``, so a batch replayed after a failure replaces its own
output instead of duplicating it; the checkpoint location records which files
were processed. No operator here differs from the batch job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import decode_path
from ..operators.ingest import ParseOptions, parse_lines
from ..operators.layout import Layout
from ..sources.text import prefix_glob


def landing_stream(spark: SparkSession, data_dir: str, file_prefix: str | None = None,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``value, file_path`` lines of new files in ``data_dir``."""
    reader = spark.readStream.format("text")
    glob = prefix_glob(file_prefix)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.load(data_dir).select(
        "value", decode_path(F.col("_metadata.file_path")).alias("file_path"))


def start_landing_ingest(spark: SparkSession, data_dir: str, layout: Layout, options: ParseOptions,
                         output_root: str, checkpoint_location: str, file_prefix: str | None = None,
                         available_now: bool = True) -> StreamingQuery:
    """Parse new files as they land; outputs per batch under ``output_root``:
    ``processed``, ``exceptions``, ``rejects`` and ``file_counts``."""
    root = output_root.rstrip("/")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_lines(batch, layout, options).persist()
        try:
            part = f"batch={batch_id}"
            parsed.typed().write.mode("overwrite").parquet(f"{root}/processed/{part}")
            parsed.exceptions().write.mode("overwrite").parquet(f"{root}/exceptions/{part}")
            parsed.width_rejects().select("value").write.mode("overwrite").text(f"{root}/rejects/{part}")
            parsed.file_counts().write.mode("overwrite").parquet(f"{root}/file_counts/{part}")
        finally:
            parsed.unpersist()

    writer = (landing_stream(spark, data_dir, file_prefix).writeStream
              .foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
