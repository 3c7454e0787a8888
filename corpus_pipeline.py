"""Corpus pipeline: the documents that a training run would read.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which
``run`` writes as Parquet and reads again as the next stage's ``docs``.

Common to all stages: an empty table gives an empty table; every column of
``docs`` comes out as it went in, also one that is named like a column that an
operator adds (the last stage's own columns excepted); repeated rows are judged
each for itself, and rows without a ``doc_id`` are rows like any other; very
long texts are read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontaminate, line_dedup, ngram_join, quality, sentencepieces
from tessera.llm.queries import PIECE_MODEL
from tessera.session import remove_dir, scratch, shared_dir


def _row(docs: DataFrame):
    """All columns as one, out of the way of the columns that operators add."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the quality classifier accepts.

    Null and empty texts are scored from their all-zero statistics, like any
    other text. Without labels of both kinds every score is the share of label
    1, so all documents stay or all go by that share.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality.score_quality(docs.select(_row(docs), "text"), quality.train_quality(docs, labels))
    return scored.where("predicted = 1").select("row.*")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take boilerplate lines out of the texts; ``n_chars``, where there is one,
    is counted anew. Every document stays: null stays null, a text without
    lines to remove stays as it is, blank lines too."""
    kept = line_dedup.dedup_lines(docs.select("doc_id", "text", "source", _row(docs)))
    columns = {c: F.col("row").getField(c) for c in docs.columns} | {"text": F.col("text")}
    if "n_chars" in columns:
        columns["n_chars"] = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return kept.select(*(column.alias(c) for c, column in columns.items()))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near duplicates, the smallest doc_id.
    Documents without words (null, empty and blank texts) and rows without a
    doc_id are no duplicates; rows that share a doc_id stay or go together."""
    classes = ngram_join.ngram_links(docs)
    duplicate = classes.where("class_id < doc_id").select("doc_id").distinct()
    return docs.join(duplicate, "doc_id", "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item. Null and empty texts and
    items match nothing; of rows that share a doc_id only those go whose own
    text holds an item."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Add the piece ids (``ids``, ``n_tokens``), after which a text can be had
    back by decoding. Columns of these names are replaced. A null text has null
    ids and 0 tokens, an empty one no ids."""
    encoded = sentencepieces.encode_pieces(docs, sentencepieces.read_model(PIECE_MODEL))
    return encoded.withColumn("n_tokens", F.size(F.coalesce("ids", F.array())))


STAGES = [("quality", quality_stage), ("line_dedup", line_stage), ("near_duplicates", near_duplicate_stage),
          ("decontamination", decontamination_stage), ("sentencepiece", encoding_stage)]

#: The classifier and the similarity join have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result is the last stage's table.

    Tables that a stage's operators save are removed with the stage, and a
    stage's own table once the next is written, after a failure as well. The
    last one stays until the application ends.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        out = shared_dir(spark, "pipeline", name)
        try:
            with scratch(spark):
                stage(spark, docs, sf_dir).write.parquet(out)
        except BaseException:
            remove_dir(spark, out)
            raise
        finally:
            if before is not None:
                remove_dir(spark, before)
        docs, before = spark.read.parquet(out), out
    return docs
