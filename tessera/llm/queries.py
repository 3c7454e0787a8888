"""Registered queries of the corpus operators: each applies one operator, with
its production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, decontaminate, html_extract, line_dedup, nearest, ngram_join, prefix_trie, quality, quality_rules, sentencepieces, suffix_dedup, toxicity, url_filter

#: Fixed rules of the URL query: host, path, verdict.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

#: Place of the public SentencePiece model that the query encodes with.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark, sf_dir):
    kept = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op2_decontaminate(spark, sf_dir):
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_html_text(spark, sf_dir):
    text = html_extract.extract_text(_table(spark, sf_dir, "pages"))
    return text.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op4_sentencepiece(spark, sf_dir, model_path: str = PIECE_MODEL):
    model = sentencepieces.read_model(model_path)
    encoded = sentencepieces.encode_pieces(_table(spark, sf_dir, "documents").select("doc_id", "text"), model)
    texts = encoded.select("doc_id", F.sha2("text", 256).alias("text_sha256"), "ids")
    decoded = sentencepieces.decode_pieces(texts, model)
    return decoded.select("doc_id", F.size(F.coalesce("ids", F.array())).alias("n_tokens"),
                          F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"),
                          F.col("text_sha256").eqNullSafe(F.sha2("decoded", 256)).alias("round_trip"))


def op5_suffix_dedup(spark, sf_dir):
    kept = suffix_dedup.dedup_suffixes(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                       F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op6_nearest(spark, sf_dir):
    return nearest.nearest_neighbours(_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op7_quality(spark, sf_dir):
    return quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_toxicity(spark, sf_dir):
    return toxicity.toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_ngram_join(spark, sf_dir):
    return ngram_join.ngram_links(_table(spark, sf_dir, "documents"))


def op10_url_filter(spark, sf_dir):
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def op11_quality_rules(spark, sf_dir):
    judged = quality_rules.filter_quality(_table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op12_collocations(spark, sf_dir):
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def _rebuilt(conversations: DataFrame) -> DataFrame:
    """Every conversation with its first h turns taken from the first of its
    five neighbours."""
    of = prefix_trie.conversation_turns(conversations)
    donor = of.select(F.col("conv_id").alias("donor"), *(F.slice(c, 1, 8).alias(f"d_{c}") for c in ("turns", "bytes")))
    c = F.col("conv_id")
    mine = of.withColumn("h", (F.crc32(c.cast("string").cast("binary")) % 9).cast("int"))
    joined = mine.join(donor, c - c % 5 == F.col("donor"), "left")

    def turns(name: str):
        given = F.slice(F.coalesce(F.col(f"d_{name}"), F.slice(name, 1, 0)), F.lit(1), F.col("h"))
        return F.concat(given, F.slice(name, F.col("h") + 1, F.size(name))).alias(name)

    return joined.select("conv_id", turns("turns"), turns("bytes"))


def op13_prefix_trie(spark, sf_dir):
    return prefix_trie.trie_nodes(_rebuilt(_table(spark, sf_dir, "conversations")))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_line_dedup, op2_decontaminate, op3_html_text, op4_sentencepiece, op5_suffix_dedup, op6_nearest,
             op7_quality, op8_toxicity, op9_ngram_join, op10_url_filter, op11_quality_rules, op12_collocations, op13_prefix_trie)
    return {f.__name__: f for f in found}
