"""Quality rules with thresholds that follow each language and source.

1. *Statistics.* numpy counts, per text and without any Python code per word:
   words, their code points, symbols, repeated lines, repeated 3-word windows.
2. *Sketches.* Each ``MEASURES`` ratio, in whole ten-thousandths, falls into a
   logarithmic bin of relative width 1/64. The bin counts of a group are its
   quantile sketch: counts add up, so sketches merge in any order (map side,
   across tasks, and from sources to languages to the corpus) with one result
   whatever the partitioning. A group of any size needs at most a few hundred
   bins for each measure.
3. *Thresholds.* From the quartiles of a sketch, per language and source: the
   median plus (and for word length also minus) ``SPREADS`` times the smaller
   of its distances to the two quartiles, so that up to a quarter of bad texts
   in a source doesn't move its fence. The distance is at least the measure's
   ``room``. A group with fewer than ``MIN_DOCS`` texts takes the merged sketch
   of its language; a language with fewer, that of the corpus.
4. *Filter.* The thresholds are joined to the statistics. A text is kept if it
   passes the base rules and all its ratios lie within its group's fences.

Sketches hold the texts that pass the base rules, since only those are judged
by them. Everything is integer arithmetic, so SQL gives the same verdicts.

Defined results: a null or empty text has no words, all counts 0, and fails the
base rules; null languages and sources are groups like any other; repeated rows
and ids are judged each for itself; an empty table gives an empty result. Very
long texts are read whole. Extra columns of the input stay, unless named like
the result's, which replace them; only the text, language and source are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import saved
from .textarrays import SPACE, SpanHash, slices, utf8, words

MIN_WORDS = 50
#: A text fails if more than this share (per cent) of its words stand in repeated windows.
MAX_REPEATED = 50
WINDOW = 3
MIN_DOCS = 100
SPREADS = 6
#: Bins per power of two of a sketch.
BINS = 64
#: Groups whose thresholds are broadcast; more of them are joined by salted keys.
BROADCAST_GROUPS = 100_000
SALTS = 64


@dataclass(frozen=True)
class Measure:
    """``count`` per ``per``, in ten-thousandths; ``room`` is the least distance
    from the median to a fence. ``both``: low values fail as well."""
    name: str
    count: str
    per: str
    room: int
    both: bool = False


MEASURES = (
    Measure("word_length", "word_chars", "n_words", 10_000, True),
    Measure("symbols", "n_symbols", "n_words", 1_000),
    Measure("dup_lines", "n_dup_lines", "n_lines", 3_000),
    Measure("repeats", "n_repeat_words", "n_words", 3_000),
)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
RESULTS = (*COUNTS, "base_failed", "kept")

_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[list(b"#*$%&|<>")] = 1
_NEWLINE = np.zeros(256, bool)
_NEWLINE[10] = True


def text_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """``COUNTS`` of every row of the UTF-8 bytes."""
    n = len(offsets) - 1

    def per_row(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[offsets[1:]] - total[offsets[:-1]]

    starts, ends, row = words(data, offsets)
    n_words = np.bincount(row, minlength=n)
    # a code point has one byte that does not continue another
    chars = per_row(~SPACE[data] & ((data & 0xC0) != 0x80))
    span = SpanHash(data)
    repeated = np.bincount(row[_in_repeated_windows(span(starts, ends), row)], minlength=n)

    line_start, line_end, line_row = words(data, offsets, _NEWLINE)
    inside = np.concatenate([[0], np.cumsum(~SPACE[data], dtype=np.int64)])
    worded = inside[line_end] > inside[line_start]
    line, line_row = span(line_start, line_end)[worded], line_row[worded]
    n_lines = np.bincount(line_row, minlength=n)
    again = line_row[_repeats_earlier(line_row, line)]
    return np.column_stack([n_words, chars, per_row(_SYMBOL[data]), np.bincount(again, minlength=n), repeated, n_lines])


def _repeats_earlier(row: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Places whose value stands at an earlier place of the same row."""
    order = np.lexsort((value, row))
    same = (row[order][1:] == row[order][:-1]) & (value[order][1:] == value[order][:-1])
    return order[1:][same]


def _in_repeated_windows(word: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Which words stand in a window that occurs twice or more in their row."""
    n = len(word)
    covered = np.zeros(n, bool)
    at = np.arange(max(n - WINDOW + 1, 0))
    at = at[row[at] == row[at + WINDOW - 1]]
    if not len(at):
        return covered
    value = SpanHash.of(word)(at, at + WINDOW)
    order = np.lexsort((value, row[at]))
    v, r = value[order], row[at][order]
    same = (r[1:] == r[:-1]) & (v[1:] == v[:-1])
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    for k in range(WINDOW):
        covered[at[twice] + k] = True
    return covered


def _count_task(kept: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text_"):
                counts = text_counts(*utf8(part.column("text_")))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *(pa.array(c) for c in counts.T.astype(np.int64))], [*kept, *COUNTS])
    return run


def text_statistics(docs: DataFrame, *, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns ``keep`` of ``docs`` and the ``COUNTS`` of its texts."""
    read = docs.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{text_col}`").cast("string").alias("text_"))
    kept = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    counts = ", ".join(f"{c} long" for c in COUNTS)
    return read.mapInArrow(_count_task(list(keep)), f"{kept}, {counts}" if keep else counts)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def ratio(m: Measure) -> Column:
    """The measure in whole ten-thousandths, rounded down."""
    return F.expr(f"10000 * {m.count} div greatest({m.per}, 1)")


def bin_start(value: Column) -> Column:
    """Lowest value of the bin: the first seven binary digits, zeros behind."""
    spare = F.greatest(F.length(F.bin(value)) - F.lit((BINS * 2 - 1).bit_length()), F.lit(0))
    power = F.element_at(F.array(*(F.lit(1 << k).cast("long") for k in range(57))), (spare + 1).cast("int"))
    return value - F.pmod(value, power)


def sketches(stats: DataFrame) -> DataFrame:
    """``lang, source, measure, bin, n``: the sketch of every language and source."""
    bins = F.explode(F.array(*(F.struct(F.lit(k).alias("measure"), bin_start(ratio(m)).alias("bin")) for k, m in enumerate(MEASURES))))
    return (stats.where(~base_failed()).select("lang_", "source_", bins.alias("b"))
            .groupBy("lang_", "source_", F.col("b.measure").alias("measure"), F.col("b.bin").alias("bin")).agg(F.count(F.lit(1)).alias("n")))


def merged(sketch: DataFrame, *keys: str) -> DataFrame:
    """Sketches of larger groups: the bins' counts added up."""
    return sketch.groupBy(*keys, "measure", "bin").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, *keys: str) -> DataFrame:
    """``keys, docs, fences``: one ``(low, high)`` per measure, from the quartiles.

    A group's bins (a few hundred) are ordered and walked with their running
    count; quartile q is the first bin by which 4 * count reaches q * all.
    """
    one = (sketch.groupBy(*keys, "measure").agg(F.sum("n").alias("docs"), F.array_sort(F.collect_list(F.struct("bin", "n"))).alias("bins")))
    counted = F.expr("""aggregate(bins, cast(array() as array<struct<bin:bigint,upto:bigint>>),
        (a, b) -> concat(a, array(named_struct('bin', b.bin, 'upto', b.n + if(size(a) = 0, 0L, a[size(a) - 1].upto)))))""")
    one = one.withColumn("bins", counted)
    for q in (1, 2, 3):
        one = one.withColumn(f"q{q}", F.expr(f"filter(bins, b -> 4 * b.upto >= {q} * docs)[0].bin"))
    room = F.element_at(F.array(*(F.lit(m.room).cast("long") for m in MEASURES)), F.col("measure") + 1)
    both = F.element_at(F.array(*(F.lit(m.both) for m in MEASURES)), F.col("measure") + 1)
    width = F.greatest(SPREADS * F.least(F.col("q3") - F.col("q2"), F.col("q2") - F.col("q1")), room)
    return (one.select(*keys, "measure", "docs", F.when(both, F.col("q2") - width).otherwise(F.lit(-1).cast("long")).alias("low"),
                       (F.col("q2") + width).alias("high"))
            .groupBy(*keys).agg(F.max("docs").alias("docs"),
                                F.array_sort(F.collect_list(F.struct("measure", "low", "high"))).alias("fences")))


def thresholds(stats: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang_, source_, fences`` of every group with texts that pass the base
    rules; small groups borrow from their language, small languages from the corpus."""
    own = saved(sketches(stats), "quality_rules", "sketches")
    corpus = fences(merged(own)).first()  # one pair of numbers a measure
    if corpus is None:
        return fences(own, "lang_", "source_").select("lang_", "source_", "fences")
    whole = F.array(*(F.struct(F.lit(f["measure"]).alias("measure"), F.lit(f["low"]).cast("long").alias("low"), F.lit(f["high"]).cast("long").alias("high"))
                      for f in corpus["fences"]))
    by_lang = fences(merged(own, "lang_"), "lang_").select(F.col("lang_").alias("l"), F.col("docs").alias("l_docs"), F.col("fences").alias("l_fences"))
    return (fences(own, "lang_", "source_").join(by_lang, F.col("lang_").eqNullSafe(F.col("l")))
            .select("lang_", "source_", F.when(F.col("docs") >= min_docs, F.col("fences"))
                    .when(F.col("l_docs") >= min_docs, F.col("l_fences")).otherwise(whole).alias("fences")))


def filter_quality(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                   min_docs: int = MIN_DOCS, broadcast_groups: int = BROADCAST_GROUPS) -> DataFrame:
    """``docs`` without its text, with ``COUNTS``, ``base_failed`` and ``kept``."""
    # the columns that stay are one, out of the way of the names used here
    kept = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text_col and c not in RESULTS))
    read = docs.select(kept.alias("row"), F.col(f"`{lang_col}`").alias("lang_"), F.col(f"`{source_col}`").alias("source_"),
                       F.col(f"`{text_col}`").alias("text"))
    stats = saved(text_statistics(read, keep=("row", "lang_", "source_")), "quality_rules", "statistics")
    limits = thresholds(stats, min_docs).select(F.col("lang_").alias("l"), F.col("source_").alias("s"), "fences")
    same = F.col("lang_").eqNullSafe(F.col("l")) & F.col("source_").eqNullSafe(F.col("s"))
    if limits.limit(broadcast_groups + 1).count() <= broadcast_groups:  # a proven bound
        joined = stats.join(F.broadcast(limits), same, "left")
    else:  # a source may hold a third of all texts: its key is salted
        salted = limits.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        mine = F.pmod(F.xxhash64(*COUNTS), F.lit(SALTS)).cast("int")
        joined = stats.withColumn("salt_", mine).join(salted, same & (F.col("salt_") == F.col("salt")), "left")
    within = F.lit(True)
    for k, m in enumerate(MEASURES):
        fence = F.element_at("fences", k + 1)
        within &= (ratio(m) >= fence["low"]) & (ratio(m) <= fence["high"])
    return joined.select("row.*", *COUNTS, base_failed().alias("base_failed"), (~base_failed() & F.coalesce(within, F.lit(False))).alias("kept"))
