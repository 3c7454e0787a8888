"""Labelled training rows for the classifiers.

``crc32(doc_id as text) mod 5 = 0`` marks held-out rows, whose labels are never
read for training. The training rows are a bounded sample: the ``limit`` rows
whose hashed ``doc_id`` is smallest, so it is the same on every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column) -> Column:
    """True for held-out rows; a row without a doc_id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def training_texts(docs: DataFrame, labels: DataFrame, label: str, limit: int) -> DataFrame:
    """``text, label`` (0/1) of at most ``limit`` labelled rows that are not
    held out. A doc_id labelled more than once counts by its largest label;
    null labels and labels other than 0 and 1 are left out. Broadcast: at most
    ``limit`` (doc_id, label) pairs."""
    sample = (labels.select(F.col("doc_id").alias("l_id"), F.col(label).cast("int").alias("label"))
              .where(F.col("label").isin(0, 1) & ~held_out(F.col("l_id")))
              .groupBy("l_id").agg(F.max("label").alias("label"))
              .orderBy(F.xxhash64(F.col("l_id")), "l_id").limit(limit))
    return (docs.select(F.col("doc_id").alias("d_id"), "text")
            .join(F.broadcast(sample), F.col("d_id") == F.col("l_id"))
            .select("text", "label"))
