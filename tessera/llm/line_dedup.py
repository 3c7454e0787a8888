"""Line dedup: remove lines that spread over many sites.

A line's key is the md5 of the line without surrounding blanks. Its spread, the
number of distinct sites it stands on, is estimated by a HyperLogLog sketch per
key; sketches are built map-side and merged by the aggregation, so a line that
stands in a third of all documents never gathers its rows in one task. Lines
whose estimate lies near ``min_sites`` get an exact distinct count, so the
decision is the exact one as long as no estimate is wrong by more than
``margin`` (ten percent by default, over six standard errors of a sketch with
4096 registers; spreads below a few hundred are counted almost exactly by the
sketch anyway).

A line on ``min_sites`` or more sites is boilerplate: every occurrence goes but
the first of the corpus (smallest doc_id, then position), so no content is lost
altogether and the first of a group of copied documents stays whole.

Defined results: a null text stays null and an empty text empty; blank lines
are never removed; a null site counts as the site ``''``; a document that loses
all lines keeps its row with an empty text. Rows that agree in doc_id and text
are treated alike and all stay; rows with a null doc_id are told apart by their
text. Extra columns are kept; input columns named ``n_lines`` or ``n_removed``
are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

MIN_SITES = 10
LOG2_REGISTERS = 12
MARGIN = 0.1


def _lines(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """``id, digest, site, pos, key`` for every line that is not blank."""
    text = F.col(f"`{text_col}`")
    return (docs.select(F.col(f"`{id_col}`").alias("id"), F.unhex(F.md5(text.cast("binary"))).alias("digest"),
                        # a sketch leaves out empty strings
                        F.concat(F.lit("="), F.coalesce(F.col(f"`{site_col}`").cast("string"), F.lit(""))).alias("site"),
                        F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))
            .where(F.trim("line") != "")
            .select("id", "digest", "site", "pos", F.unhex(F.md5(F.trim("line").cast("binary"))).alias("key")))


def spread_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
                 min_sites: int = MIN_SITES, margin: float = MARGIN) -> DataFrame:
    """``key, first_id, first_digest, first_pos`` of the lines on ``min_sites`` sites or more."""
    ensure_checkpoint_dir(docs.sparkSession)
    lines = _lines(docs, id_col, text_col, site_col)
    likely = (lines.groupBy("key")
              .agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LOG2_REGISTERS))).alias("sites"),
                   F.min(F.struct("id", "digest", "pos")).alias("first"))
              .where(F.col("sites") >= min_sites * (1 - margin))
              .select("key", "sites", F.col("first.id").alias("first_id"), F.col("first.digest").alias("first_digest"),
                      F.col("first.pos").alias("first_pos"))
              .checkpoint())
    sure = F.col("sites") > min_sites * (1 + margin)
    exact = (lines.join(likely.where(~sure).select("key"), "key", "left_semi")
             .select("key", "site").distinct()
             .groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_sites))
    return likely.where(sure).unionByName(likely.where(~sure).join(exact.select("key"), "key", "left_semi")).drop("sites")


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
                min_sites: int = MIN_SITES, margin: float = MARGIN) -> DataFrame:
    """``docs`` with the repeated boilerplate lines taken out of ``text_col``,
    and the columns ``n_lines`` and ``n_removed``."""
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    spread = spread_lines(docs, id_col=id_col, text_col=text_col, site_col=site_col, min_sites=min_sites, margin=margin)
    is_first = (F.col("id").eqNullSafe(F.col("first_id")) & (F.col("digest") == F.col("first_digest"))
                & (F.col("pos") == F.col("first_pos")))
    gone = (_lines(docs, id_col, text_col, site_col).join(spread, "key").where(~is_first)
            .groupBy(F.col("id").alias("g_id"), F.col("digest").alias("g_digest"))
            .agg(F.collect_set("pos").alias("gone")))  # at most one document's lines
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc"),
                       F.col(f"`{id_col}`").alias("id"),
                       F.unhex(F.md5(F.col(f"`{text_col}`").cast("binary"))).alias("digest"))
    joined = rows.join(gone, rows["id"].eqNullSafe(gone["g_id"]) & (rows["digest"] == gone["g_digest"]), "left")
    text = F.col("doc").getField(text_col)
    lines = F.split(text, "\n", -1)
    return joined.select(*[_kept_text(text, lines).alias(c) if c == text_col else F.col("doc").getField(c).alias(c) for c in names],
                         F.coalesce(F.when(text.isNotNull(), F.size(lines)), F.lit(0)).alias("n_lines"),
                         F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).alias("n_removed"))


def _kept_text(text: Column, lines: Column) -> Column:
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
    return F.when(F.col("gone").isNull(), text).otherwise(
        F.array_join(F.transform(F.array_sort(kept), lambda i: F.get(lines, i)), "\n"))
