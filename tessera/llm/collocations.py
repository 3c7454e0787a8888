"""Phrase collocation mining on a prefix-free parse of the corpus.

*Parse.* A text becomes a sequence of words and piece ends. Two neighbouring
words whose hash is divisible by ``TRIGGER`` form a trigger; the text is cut
into chunks that run from one trigger to the end of the next, so neighbouring
chunks overlap by the two words of a trigger, and equal passages are cut alike
wherever they stand. The distinct chunks of a language are the dictionary, with
their frequencies in the parse: a passage copied a thousand times is looked at
once, weighted by a thousand.

*Counting.* A chunk owns the phrases that start before its last two words (the
last chunk of a text: all its phrases), and holds them whole, so every
occurrence is counted once. Counting takes two passes over the dictionary:

1. words and pairs are hashed to ``2 ** FILTER_BITS`` places; a place's weighted
   count is no less than that of any phrase hashed to it. Each task sends sorted
   places and counts by page, so a phrase costs a few bytes and a frequent one
   is summed before it is sent. Places that reach ``least`` make a bit map of
   fixed size, ``2 ** FILTER_BITS / 8`` bytes, the only thing tasks are given.
2. words and pairs at such places, and triples both of whose pairs are, are
   counted by their own text, and those below ``least`` dropped. The bit map can
   only let too much through, so counts are exact at any size of corpus.

*Scores.* Everything after that are joins and aggregations of the phrases with
``least`` occurrences or more. Common words begin or end many phrases: parts of
high counts are joined by salted keys. Products are decimals of 38 digits.

Defined results: a null text is empty; a null language is ``und``; repeated
rows count again; texts without words and empty tables add nothing. Very long
texts are cut into chunks like any other; one without triggers is one chunk.
Only the text and language columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import saved
from .hotkeys import HOT_ROWS, MAX_HOT
from .textarrays import SpanHash, mix, slices, utf8, words

LEAST = 10
COVER = 50
TOP = 2000
TRIGGER = 32
FILTER_BITS = 28
PAGE_BITS = 18
#: Keys that a task gathers before it sends their counts.
GATHERED = 1_500_000
#: Different phrases that a task gathers before it sends their counts.
HELD_ROWS = 400_000
SLICE_BYTES = 1_500_000
PARSE_BYTES = 1_000_000
TOP_GROUPS = 64

_U = np.uint64
SPACE, BREAK = 32, 10
#: Between words, and between pieces.
_GAP = np.zeros(256, bool)
_GAP[list(b" \t.,;:!?\n\v\f\r")] = True
_PIECE = np.zeros(256, bool)
_PIECE[list(b".,;:!?\n\v\f\r")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def spans(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All places of the spans, one span after the other."""
    size = ends - starts
    return np.arange(size.sum()) + np.repeat(starts - (np.cumsum(size) - size), size)


def strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans of the UTF-8 bytes as strings."""
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[spans(starts, ends)])))


# --- parse --------------------------------------------------------------------

def normal_form(data: np.ndarray, offsets: np.ndarray):
    """Lower-cased words with one blank between them, or a line break where a
    piece ends: ``bytes, starts, ends, row, breaks`` (whether a piece ends
    before the word)."""
    data = _LOWER[data]
    start, end, row = words(data, offsets, _GAP)
    if not len(start):
        return np.zeros(0, np.uint8), start, end, row, np.zeros(0, bool)
    pieces = np.concatenate([[0], np.cumsum(_PIECE[data], dtype=np.int64)])
    breaks = np.zeros(len(start), bool)
    breaks[1:] = pieces[start[1:]] > pieces[end[:-1]]
    size = end - start
    to = np.cumsum(size + 1)
    flat = np.full(to[-1], SPACE, np.uint8)
    flat[spans(to - size - 1, to - 1)] = data[spans(start, end)]
    flat[(to - 1)[:-1][breaks[1:]]] = BREAK
    return flat, to - size - 1, to - 1, row, breaks


def chunk_bounds(flat: np.ndarray, start: np.ndarray, end: np.ndarray, row: np.ndarray, breaks: np.ndarray, trigger: int):
    """``first, last, closing`` of every chunk: its words ``first`` to ``last``,
    and whether the text ends with it."""
    n = len(start)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, bool)
    h = SpanHash(flat)(start, end)
    pair = mix(h[:-1] * _U(3) + mix(h[1:] + breaks[1:].astype(_U)))
    opens = np.zeros(n, bool)
    opens[:-1] = (pair % _U(trigger) == 0) & (row[1:] == row[:-1])
    opens[0] = True
    opens[1:] |= row[1:] != row[:-1]
    first = np.flatnonzero(opens)
    closing = np.append(row[first[1:]] != row[first[:-1]], True)
    last = np.append(first[1:] - 1, n - 1)
    last[~closing] += 2
    return first, last, closing


def _parse_task(trigger: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", PARSE_BYTES):
                flat, start, end, row, breaks = normal_form(*utf8(part.column("text")))
                first, last, closing = chunk_bounds(flat, start, end, row, breaks, trigger)
                if len(first):
                    owned = np.where(closing, last - first + 1, last - first - 1)
                    yield pa.RecordBatch.from_arrays([part.column("lang").take(pa.array(row[first])), strings(flat, start[first], end[last]),
                                                      pa.array(closing), pa.array(owned)], ["lang", "chunk", "closing", "owned"])
    return run


def parse(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", trigger: int = TRIGGER) -> DataFrame:
    """The dictionary: ``lang, chunk, closing, owned, freq``."""
    read = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return (read.mapInArrow(_parse_task(trigger), "lang string, chunk string, closing boolean, owned long")
            .groupBy("lang", "chunk", "closing", "owned").agg(F.count(F.lit(1)).alias("freq")))


# --- phrases of chunks --------------------------------------------------------

class Phrases:
    """Words, pairs and triples that the chunks of one slice own."""

    def __init__(self, part: pa.RecordBatch):
        self.data, offsets = utf8(part.column("chunk"))
        gap = np.zeros(256, bool)
        gap[[SPACE, BREAK]] = True
        self.start, self.end, self.row = words(self.data, offsets, gap)
        n, n_rows = len(self.start), part.num_rows
        count = np.bincount(self.row, minlength=n_rows)
        place = np.arange(n) - np.repeat(np.cumsum(count) - count, count)
        owned = place < part.column("owned").to_numpy()[self.row]
        #: whether the next word is in the same piece
        self.joined = np.zeros(n, bool)
        self.joined[:-1] = (self.row[1:] == self.row[:-1]) & (self.data[np.minimum(self.end[:-1], max(len(self.data) - 1, 0))] == SPACE)
        two = owned & self.joined
        three = two.copy()
        three[:-1] &= self.joined[1:]
        self.first = {1: np.flatnonzero(owned), 2: np.flatnonzero(two), 3: np.flatnonzero(three)}
        self.freq = part.column("freq").to_numpy()
        lang = part.column("lang").dictionary_encode()
        self.lang_of_row = lang.indices.to_numpy()
        self.langs = lang.dictionary
        seed = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in lang.dictionary.to_pylist()], np.uint64)
        self.seed = seed[self.lang_of_row[self.row]] if n else np.zeros(0, np.uint64)
        self.hash = SpanHash(self.data)

    def places(self, size: int, at: np.ndarray) -> np.ndarray:
        """Filter places of the phrases of ``size`` words that start at words ``at``."""
        h = self.hash(self.start[at], self.end[at + size - 1])
        return (mix(h ^ self.seed[at]) >> _U(64 - FILTER_BITS)).astype(np.uint32)

    def weights(self, at: np.ndarray) -> np.ndarray:
        return self.freq[self.row[at]]


def _places_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weighted counts by place, a page of places in a row."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    rows = 0

    def send() -> pa.RecordBatch:
        place, weight = (np.concatenate(x) for x in zip(*held, strict=True))
        place, at = np.unique(place, return_inverse=True)
        count = np.minimum(np.bincount(at, weight), 255).astype(np.uint8)  # enough to tell whether LEAST is reached
        page = place >> PAGE_BITS
        cut = np.flatnonzero(np.append(True, page[1:] != page[:-1]))
        upto = np.append(cut[1:], len(page))
        within = (place & ((1 << PAGE_BITS) - 1)).astype(np.uint32)
        return pa.RecordBatch.from_arrays(
            [pa.array(page[cut].astype(np.int32)), pa.array([within[a:b].tobytes() for a, b in zip(cut, upto, strict=True)], pa.binary()),
             pa.array([count[a:b].tobytes() for a, b in zip(cut, upto, strict=True)], pa.binary())], ["page", "places", "counts"])

    for batch in batches:
        for part in slices(batch, "chunk", SLICE_BYTES):
            phrases = Phrases(part)
            for size in (1, 2):
                at = phrases.first[size]
                held.append((phrases.places(size, at), phrases.weights(at).astype(float)))
                rows += len(at)
            if rows > GATHERED:
                yield send()
                held, rows = [], 0
    if rows:
        yield send()


def _page_task(least: int):
    """Places of each page that reach ``least`` (rows come sorted by page)."""
    def bits(counter: np.ndarray) -> bytes:
        return np.packbits(counter >= least).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        page, counter = None, None
        for batch in batches:
            for p, places, counts in zip(*(batch.column(c).to_pylist() for c in ("page", "places", "counts")), strict=True):
                if p != page:
                    if page is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([page], pa.int32()), pa.array([bits(counter)], pa.binary())], ["page", "bits"])
                    page, counter = p, np.zeros(1 << PAGE_BITS, np.int64)
                counter[np.frombuffer(places, np.uint32)] += np.frombuffer(counts, np.uint8)  # a row's places are distinct
        if page is not None:
            yield pa.RecordBatch.from_arrays([pa.array([page], pa.int32()), pa.array([bits(counter)], pa.binary())], ["page", "bits"])
    return run


def frequent_places(dictionary: DataFrame, least: int) -> np.ndarray:
    """Bit map of the places whose weighted count reaches ``least`` (at most 255)."""
    pages = (dictionary.mapInArrow(_places_task, "page int, places binary, counts binary")
             .repartition("page").sortWithinPartitions("page").mapInArrow(_page_task(min(least, 255)), "page int, bits binary"))
    out = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    size = (1 << PAGE_BITS) // 8
    for r in pages.toLocalIterator():
        out[r["page"] * size:(r["page"] + 1) * size] = np.frombuffer(r["bits"], np.uint8)
    return out


def _texts_task(bitmap: np.ndarray):
    """Phrases that may be frequent, summed by their text within a slice."""
    def passes(place: np.ndarray) -> np.ndarray:
        return (bitmap[place >> np.uint32(3)] >> (np.uint32(7) - (place & np.uint32(7))).astype(np.uint8)) & 1 == 1

    def phrases(part: pa.RecordBatch) -> Iterator[pa.Table]:
        p = Phrases(part)
        # a pair that this chunk doesn't own may end a triple that it does
        every = np.flatnonzero(p.joined)
        common = np.zeros(len(p.start) + 1, bool)
        common[every] = passes(p.places(2, every))
        one, two, three = (p.first[k] for k in (1, 2, 3))
        for size, at in ((1, one[passes(p.places(1, one))]), (2, two[common[two]]), (3, three[common[three] & common[three + 1]])):
            yield pa.table({"lang": p.langs.take(pa.array(p.lang_of_row[p.row[at]])).dictionary_encode(), "size": np.full(len(at), size, np.int32),
                            "phrase": strings(p.data, p.start[at], p.end[at + size - 1]), "f": p.weights(at)})

    def summed(tables: list[pa.Table]) -> pa.Table:
        return (pa.concat_tables(tables).unify_dictionaries().group_by(["lang", "size", "phrase"]).aggregate([("f", "sum")])
                .rename_columns(["lang", "size", "phrase", "f"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        rows = 0
        for batch in batches:
            for part in slices(batch, "chunk", SLICE_BYTES):
                held.append(summed(list(phrases(part))))
                rows += held[-1].num_rows
                if rows > HELD_ROWS:  # what recurs in later slices is summed before it is sent
                    total = summed(held)
                    held, rows = [total], total.num_rows
                    if rows > HELD_ROWS // 2:
                        yield from _plain(total)
                        held, rows = [], 0
                    pa.default_memory_pool().release_unused()
        if held:
            yield from _plain(summed(held))
    return run


def _plain(table: pa.Table) -> list[pa.RecordBatch]:
    return table.set_column(0, "lang", table.column("lang").cast(pa.string())).combine_chunks().to_batches()


def phrase_counts(dictionary: DataFrame, least: int = LEAST) -> DataFrame:
    """``lang, size, phrase, f`` of the phrases of up to three words that occur
    ``least`` times or more."""
    bitmap = frequent_places(dictionary, least)
    return (dictionary.mapInArrow(_texts_task(bitmap), "lang string, size int, phrase string, f long")
            .groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= least))


# --- scores -------------------------------------------------------------------

def _word(k: int) -> Column:
    return F.element_at(F.split("phrase", " "), k)


def _with_count(phrases: DataFrame, part: Column, counts: DataFrame, name: str, crowd: int) -> DataFrame:
    """``name``: the count of ``part``. A part with a count of ``crowd`` or more
    may be in very many phrases: these are salted, by as many salts as the count
    holds crowds. There are at most ``MAX_HOT`` such parts, which are broadcast."""
    keyed = counts.select("lang", F.col("phrase").alias("part"), F.col("f").alias(name), (F.expr(f"f div {crowd}") + 1).cast("int").alias("salts"))
    crowded = keyed.where("salts > 1").select("lang", "part", "salts")
    salted = keyed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    mine = F.pmod(F.xxhash64("phrase"), F.coalesce("salts", F.lit(1))).cast("int")
    return (phrases.withColumn("part", part).join(F.broadcast(crowded), ["lang", "part"], "left").withColumn("salt", mine).drop("salts")
            .join(salted, ["lang", "part", "salt"]).drop("part", "salt"))


def _score(l: str, r: str) -> Column:  # noqa: E741
    a2 = "cast(a as decimal(18,0)) * cast(a as decimal(18,0))"
    return F.expr(f"cast((cast(1000000 as decimal(7,0)) * ({a2})) div (cast({l} as decimal(18,0)) * cast({r} as decimal(18,0))) as bigint)")


def collocations(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, cover: int = COVER, top: int = TOP,
                 trigger: int = TRIGGER) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top`` phrases
    of two and three words."""
    dictionary = saved(parse(docs, text_col=text_col, lang_col=lang_col, trigger=trigger), "collocations", "dictionary")
    total = dictionary.groupBy("lang").agg(F.sum(F.col("owned") * F.col("freq")).alias("n"))
    # phrases with one first (or last) word occur least times each, and apart from each other
    n_words = total.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    crowd = max(HOT_ROWS * least, n_words // MAX_HOT)
    counts = saved(phrase_counts(dictionary, least), "collocations", "counts")
    of = {k: counts.where(F.col("size") == k).select("lang", "phrase", "f") for k in (1, 2, 3)}
    one, two, three = of[1], *(of[k].withColumnRenamed("f", "a") for k in (2, 3))

    def counted(phrases: DataFrame, part: Column, of: DataFrame, name: str) -> DataFrame:
        return _with_count(phrases, part, of, name, crowd)

    two = counted(counted(two, _word(1), one, "l"), _word(2), one, "r").withColumn("score", _score("l", "r"))
    longer = (three.select("lang", F.explode(F.array(F.concat_ws(" ", _word(1), _word(2)), F.concat_ws(" ", _word(2), _word(3)))).alias("phrase"), "a")
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    two = two.join(longer, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("longer") < cover * F.col("a"), F.lit(True))).drop("longer")

    cut = counted(counted(three, _word(1), one, "l1"), F.concat_ws(" ", _word(2), _word(3)), of[2], "r1")
    cut = counted(counted(cut, F.concat_ws(" ", _word(1), _word(2)), of[2], "l2"), _word(3), one, "r2")
    cut = cut.withColumn("s1", _score("l1", "r1")).withColumn("s2", _score("l2", "r2"))
    first = F.col("s1") <= F.col("s2")
    three = cut.select("lang", "phrase", "a", F.when(first, F.col("l1")).otherwise(F.col("l2")).alias("l"),
                       F.when(first, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("s1", "s2").alias("score"))

    ranked = _first(two.select(*three.columns).unionByName(three), top)
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _first(phrases: DataFrame, top: int) -> DataFrame:
    """The first ``top`` phrases of each language, with their ``rank``: first of
    ``TOP_GROUPS`` groups of its phrases, then of those that are left. So a
    language's last task reads ``TOP_GROUPS * top`` rows at most."""
    order = (F.desc("score"), F.desc("a"), "phrase")
    in_group = F.row_number().over(Window.partitionBy("lang", "group").orderBy(*order))
    grouped = phrases.withColumn("group", F.pmod(F.xxhash64("phrase"), F.lit(TOP_GROUPS)))
    some = grouped.withColumn("rank", in_group).where(F.col("rank") <= top).drop("rank", "group")
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
