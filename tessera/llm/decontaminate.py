"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit check.

A document holds a benchmark item when some run of its words lies within an
edit distance (insertions, deletions, substitutions of whole words) of
``MAX_EDITS`` times the item's length. Words are compared in ASCII lower case,
without regard to white space and the punctuation around them.

The CGK embedding turns edit distance into Hamming distance by a random walk:
at step j the walk writes the word it stands on and moves on or stays, as a
random bit of (j, word) says. Two windows that differ by few edits fall into
step again, so most of their outputs agree. Bit sampling keeps ``SAMPLES``
outputs of the first ``STEPS`` steps as a key; ``REPETITIONS`` independent
walks and samples are tried, from each of several anchor words of every item,
and at every word of every document, so that edits in one part of an item
leave other keys whole. A key that meets one of an item's keys is a candidate,
and each candidate window is verified exactly by dynamic programming.

A walk of up to ``STEPS`` words needs an item that is longer. Items of fewer
than ``SHORT_WORDS`` words are cut into one part more than edits are allowed:
whatever the edits, one part stands whole in the document, and its words are
the key. So no short item is missed (up to 64-bit hashes); of longer ones with
all edits that are allowed the walks find 0.995.

*Small and large benchmarks.* The items' keys are a table. If the benchmark has
no more than ``BROADCAST_WORDS`` words (its size is counted first), tasks get the
keys and verify where the documents are, as in a broadcast join. A larger one is
joined: documents are searched with two bit maps of fixed size, of the first
words of keys and of the keys themselves, those that pass are joined with the
items by key, and the pairs are verified after a join with the items' words.
Keys and items that many documents share are salted over ``SALTS`` tasks. Both ways
try the same keys and give the same rows.

A document position costs a few array operations per repetition: positions
whose first sampled word is no item's are dropped at once, and only the rest
walk on.

Defined results: null or empty documents and items match nothing; an item whose
allowance has room for no edit (fewer than 5 words) is searched for exactly;
repeated documents and repeated items give repeated rows; equal
distances take the smallest start. Empty tables give an
empty result. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..session import saved
from .placebits import has_place, place_bits
from .textarrays import SpanHash, mix, signed, slices, utf8, words

MAX_EDITS = 0.2
REPETITIONS = 8
SAMPLES = 4
STEPS = 20
SHORT_WORDS = 24
ANCHOR_EVERY = 6
BROADCAST_WORDS = 500_000
FILTER_BITS = 28
SALTS = 16

_random = np.random.default_rng(1803)
_WALK = _random.integers(1, 1 << 63, (REPETITIONS, STEPS), dtype=np.uint64) | np.uint64(1)
_SAMPLED = np.array([np.sort(_random.choice(STEPS, SAMPLES, replace=False)) for _ in range(REPETITIONS)])

#: ASCII white space, and punctuation, which is trimmed off both ends of words.
_TRIM = np.zeros(256, bool)
_TRIM[:48] = True
_TRIM[58:65] = True
_TRIM[91:97] = True
_TRIM[123:128] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Stands behind the last word of a text: never equal to a word's hash in practice.
_END = np.uint64(0x8000000000000001)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every word that has a letter, digit or non-ASCII byte."""
    start, end, row = words(data, offsets)
    kept = ~_TRIM[data]
    before = np.concatenate([[0], np.cumsum(kept)])
    at = np.flatnonzero(kept)
    some = before[end] > before[start]
    start, end, row = start[some], end[some], row[some]
    first, last = at[before[start]], at[before[end] - 1] + 1
    return SpanHash(_LOWER[data])(first, last), row


def _padded(h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words with ``STEPS`` end marks behind every row, so a walk never
    leaves its row; and the place of every word."""
    new = np.append(0, (row[1:] != row[:-1]).astype(np.int64)) if len(row) else np.zeros(0, np.int64)
    place = np.arange(len(h)) + STEPS * np.cumsum(new)
    out = np.full(len(h) + STEPS * (int(new.sum()) + 1), _END)
    out[place] = h
    return out, place


def _walk(h: np.ndarray, at: np.ndarray, repetition: int, first: int, last: int) -> np.ndarray:
    for step in range(first, last):
        at = at + ((h[at] * _WALK[repetition, step]) >> np.uint64(63)).view(np.int64)
    return at


def _keys(h: np.ndarray, at: np.ndarray, repetition: int, wanted: np.ndarray | None):
    """Walk from every start; ``(kept starts' indices, keys)``. With ``wanted``,
    a bitmap over the top 16 bits of the first sampled word, only the starts
    that meet it walk on."""
    sampled = _SAMPLED[repetition].tolist()
    at = _walk(h, at, repetition, 0, sampled[0])
    if wanted is None:
        index = np.arange(len(at))
    else:
        index = np.flatnonzero(wanted[h[at] >> np.uint64(48)])
        at = at[index]
    key = np.full(len(at), repetition + 1, np.uint64)
    for this, following in zip(sampled, [*sampled[1:], sampled[-1]], strict=True):
        key = mix(key ^ h[at])
        at = _walk(h, at, repetition, this, following)
    return index, key


def _part_keys(h: np.ndarray, at: np.ndarray, length: int, wanted: np.ndarray | None):
    """Like ``_keys``, for the next ``length`` words of every place."""
    index = np.arange(len(at)) if wanted is None else np.flatnonzero(wanted[h[at] >> np.uint64(48)])
    at = at[index]
    key = np.full(len(at), length, np.uint64)
    for step in range(length):
        key = mix(key ^ h[at + step])
    return index, key


def _parts(n: int, edits: int) -> list[tuple[int, int]]:
    """First word and length of ``edits + 1`` parts of ``n`` words. ``STEPS``
    words of a longer part are enough (and stay within a row's end marks)."""
    cuts = [k * n // (edits + 1) for k in range(edits + 2)]
    return [(a, min(b - a, STEPS)) for a, b in zip(cuts, cuts[1:], strict=False)]


def allowed_edits(n_words: np.ndarray, max_edits: float) -> np.ndarray:
    return np.floor(max_edits * n_words + 1e-9).astype(np.int64)


# A search is the repetition of a walk, or the length of parts above all repetitions.

def _is_part(search: int) -> bool:
    return search >= REPETITIONS


def _first_words(h: np.ndarray, at: np.ndarray, search: int) -> np.ndarray:
    """Top 16 bits of the first word that a key of the search takes."""
    first = at if _is_part(search) else _walk(h, at, search, 0, int(_SAMPLED[search][0]))
    return (h[first] >> np.uint64(48)).astype(np.int64)


def _search(h: np.ndarray, at: np.ndarray, search: int, wanted: np.ndarray | None):
    """``(kept starts' indices, keys)`` of one search."""
    return _part_keys(h, at, search - REPETITIONS, wanted) if _is_part(search) else _keys(h, at, search, wanted)


def key_place(key: np.ndarray, search: int) -> np.ndarray:
    return (mix(key + np.uint64(search)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def item_anchors(n_words: np.ndarray, edits: np.ndarray) -> dict[int, list[tuple[int, int]]]:
    """``(item, word)`` from which keys are taken, by search."""
    walked, parts = [], {}
    for i, (n, e) in enumerate(zip(n_words.tolist(), edits.tolist(), strict=True)):
        if n >= SHORT_WORDS:
            # an anchor needs some words behind it, or keys would be made of the end mark
            walked += [(i, place) for place in range(0, n - STEPS // 2 - 1, ANCHOR_EVERY)]
        elif n:
            for place, length in _parts(n, e):
                parts.setdefault(REPETITIONS + length, []).append((i, place))
    # items end at their last word, windows of documents go on: a walk that
    # leaves an item's end never meets, other anchors and repetitions do
    return {**({r: walked for r in range(REPETITIONS)} if walked else {}), **parts}


def edit_windows(pattern: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Smallest word edit distance of ``pattern`` to any run of each row of
    ``windows``, with the run's start and end in the window (smallest start)."""
    n, width = windows.shape
    column = np.arange(width + 1)
    big = np.int64(1) << 32
    # distance and start packed as one integer, so the minimum takes both
    row = np.broadcast_to(column, (n, width + 1)).astype(np.int64).copy()
    for i, word in enumerate(pattern, 1):
        change = row[:, :-1] + np.where(windows == word, 0, big)
        new = np.empty_like(row)
        new[:, 0] = i * big
        new[:, 1:] = np.minimum(change, row[:, 1:] + big)
        # insertions of window words run along the row: a running minimum
        row = np.minimum.accumulate(new - column * big, axis=1) + column * big
    end = row.argmin(1)
    best = row[np.arange(n), end]
    return best >> np.int64(32), best & (big - 1), end


class Patterns:
    """Items by number: word hashes, allowance."""

    def __init__(self, hashes: list[np.ndarray], edits: np.ndarray):
        self.hashes, self.edits = hashes, edits

    def verified(self, h: np.ndarray, row: np.ndarray, doc: np.ndarray, item: np.ndarray, diagonal: np.ndarray) -> np.ndarray:
        """``(row, item, distance, start)`` of the candidates within their
        allowance, per row and item the best place. Candidates are rows, items
        and the place in ``h`` at which the item would start; ``start`` counts
        the row's words from 0."""
        if not len(item):
            return np.zeros((0, 4), np.int64)
        first, last = np.searchsorted(row, doc, "left"), np.searchsorted(row, doc, "right")
        out = []
        order = np.argsort(item, kind="stable")
        cut = np.flatnonzero(np.append(True, item[order][1:] != item[order][:-1]))
        for lo, hi in zip(cut, [*cut[1:], len(item)], strict=True):
            mine = order[lo:hi]
            i = int(item[mine[0]])
            pattern, allowed = self.hashes[i], int(self.edits[i])
            width = len(pattern) + 6 * max(allowed, 1) + 2
            known = np.sort(pattern)
            for at in range(0, len(mine), 512):
                some = mine[at:at + 512]
                place = (diagonal[some] - 2 * max(allowed, 1))[:, None] + np.arange(width)
                inside = (place >= first[some][:, None]) & (place < last[some][:, None])
                windows = np.where(inside, h[np.clip(place, 0, len(h) - 1)], _END)
                # a run within the allowance shares all but ``allowed`` of the item's words
                shared = (known[np.minimum(np.searchsorted(known, windows), len(known) - 1)] == windows).sum(1)
                enough = shared >= len(pattern) - allowed
                some, place, windows = some[enough], place[enough], windows[enough]
                if not len(some):
                    continue
                distance, begin, _ = edit_windows(pattern, windows)
                ok = distance <= allowed
                start = np.maximum(place[np.arange(len(some)), np.minimum(begin, width - 1)] - first[some], 0)
                out.append(np.column_stack([doc[some], np.full(len(some), i), distance, start])[ok])
        if not out:
            return np.zeros((0, 4), np.int64)
        rows = np.concatenate(out)
        rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
        return rows[new]


def diagonals(at: np.ndarray, anchor: np.ndarray, edits: np.ndarray) -> np.ndarray:
    """Where the item would start; neighbouring ones are verified as one, whose
    window covers them all."""
    step = np.maximum(edits, 1)
    return (at - anchor) // step * step


class _Held:
    """A small benchmark, ready to be searched for: per search its sorted keys
    and what they stand for."""

    def __init__(self, hashes: list[np.ndarray], max_edits: float):
        n = np.array([len(x) for x in hashes], np.int64)
        self.patterns = Patterns(hashes, allowed_edits(n, max_edits))
        padded, place = _padded(np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), np.repeat(np.arange(len(n)), n))
        begin = np.concatenate([[0], np.cumsum(n)])
        self.searches = []
        for search, entries in item_anchors(n, self.patterns.edits).items():
            item, anchor = np.array(entries, np.int64).T
            start = place[begin[item] + anchor]
            wanted = np.zeros(1 << 16, bool)
            wanted[_first_words(padded, start, search)] = True
            _, key = _search(padded, start, search, None)
            order = np.argsort(key, kind="stable")
            self.searches.append((search, key[order], item[order], anchor[order], wanted))

    def leaks(self, h: np.ndarray, row: np.ndarray) -> np.ndarray:
        """``(row, item, distance, start)`` of the documents' words."""
        if not len(h) or not self.searches:
            return np.zeros((0, 4), np.int64)
        padded, start = _padded(h, row)
        found = []
        for search, keys, item, anchor, wanted in self.searches:
            index, key = _search(padded, start, search, wanted)
            lo, hi = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
            hit = np.flatnonzero(hi > lo)
            times = (hi - lo)[hit]
            entry = np.repeat(lo[hit], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            at = np.repeat(index[hit], times)
            found.append(np.column_stack([item[entry], row[at], diagonals(at, anchor[entry], self.patterns.edits[item[entry]])]))
        item, doc, diagonal = np.unique(np.concatenate(found), axis=0).T
        return self.patterns.verified(h, row, doc, item, diagonal)


# --- Spark steps --------------------------------------------------------------

def _item_task(max_edits: float):
    """Word hashes of the items."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                h, row = word_hashes(*utf8(part.column("text")))
                n = np.bincount(row, minlength=part.num_rows)
                end = np.cumsum(n)
                made = [h[b - c:b].tobytes() for b, c in zip(end.tolist(), n.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("item_id"), pa.array(made, pa.binary()), pa.array(n.astype(np.int32)),
                                                  pa.array(allowed_edits(n, max_edits).astype(np.int32))], ["item_id", "words", "n_words", "edits"])
    return run


def _item_keys_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All keys of the items, with the item's word at which each begins."""
    for batch in batches:
        n, edits, item = (batch.column(c).to_numpy() for c in ("n_words", "edits", "item"))
        h = np.frombuffer(b"".join(batch.column("words").to_pylist()), np.uint64)
        padded, place = _padded(h, np.repeat(np.arange(len(n)), n))
        begin = np.concatenate([[0], np.cumsum(n)])
        for search, entries in item_anchors(n, edits).items():
            who, anchor = np.array(entries, np.int64).T
            start = place[begin[who] + anchor]
            _, key = _search(padded, start, search, None)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(key), search, np.int32)), pa.array(signed(key)), pa.array(key_place(key, search)), pa.array(_first_words(padded, start, search)),
                 pa.array(item[who]), pa.array(anchor.astype(np.int32)), pa.array(edits[who])], ["search", "key", "place", "first", "item", "anchor", "edits"])


class _Benchmark:
    """The items as a table; if they are few, their hashes and ids too."""

    def __init__(self, benchmark: DataFrame, id_col: str, text_col: str, max_edits: float, broadcast_words: int):
        read = benchmark.select(F.col(f"`{id_col}`").alias("item_id"), F.col(f"`{text_col}`").cast("string").alias("text")).where("text is not null")
        self.id_type = read.schema["item_id"].dataType.simpleString()
        self.max_edits = max_edits
        made = saved(read.mapInArrow(_item_task(max_edits), f"item_id {self.id_type}, words binary, n_words int, edits int").where("n_words > 0"),
                     "decontaminate", "items")
        self.n_words = made.agg(F.coalesce(F.sum("n_words"), F.lit(0)).alias("n")).first()["n"]
        self.small = self.n_words <= broadcast_words
        if self.small:
            rows = made.select("item_id", "words").orderBy("item_id", "words").collect()
            self.ids = [r["item_id"] for r in rows]
            self.hashes = [np.frombuffer(r["words"], np.uint64) for r in rows]
            return
        # numbered in a table of their own, so that numbers stay
        self.items = saved(made.withColumn("item", F.monotonically_increasing_id()), "decontaminate", "numbered")
        self.keys = saved(self.items.select("item", "words", "n_words", "edits").mapInArrow(
            _item_keys_task, "search int, key long, place long, first long, item long, anchor int, edits int"), "decontaminate", "keys")
        self.wanted: dict[int, np.ndarray] = {}
        for r in self.keys.select("search", "first").distinct().toLocalIterator():  # at most 2 ** 16 of each search
            self.wanted.setdefault(r["search"], np.zeros(1 << 16, bool))[r["first"]] = True
        self.places = place_bits(self.keys, FILTER_BITS)


def _leak_task(ids: list, hashes: list[np.ndarray], max_edits: float, id_type: pa.DataType):
    """The leaks of every row (``row, text``), from a small benchmark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held(hashes, max_edits)
        n_words = np.array([len(x) for x in hashes], np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                rows = held.leaks(*word_hashes(*utf8(part.column("text"))))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array(rows[:, 0])), pa.array([ids[i] for i in rows[:, 1]], id_type),
                     *(pa.array(x.astype(np.int32)) for x in (rows[:, 2], n_words[rows[:, 1]], rows[:, 3]))],
                    ["id", "item_id", "distance", "item_words", "start_word"])
    return run


def _clean_task(hashes: list[np.ndarray], max_edits: float):
    """The rows without leaks, from a small benchmark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held(hashes, max_edits)
        for batch in batches:
            for part in slices(batch, "text"):
                clean = np.ones(part.num_rows, bool)
                clean[held.leaks(*word_hashes(*utf8(part.column("text"))))[:, 0]] = False
                yield pa.RecordBatch.from_arrays([part.column("row").filter(pa.array(clean))], ["row"])
    return run


def _hits(h: np.ndarray, row: np.ndarray, wanted: dict[int, np.ndarray], places: np.ndarray):
    """``(row, place, search, key)`` of the document words whose keys pass the
    bit maps, by row."""
    padded, start = _padded(h, row)
    found = []
    for search, first in sorted(wanted.items()):
        index, key = _search(padded, start, search, first)
        passed = has_place(places, key_place(key, search))
        index, key = index[passed], key[passed]
        found.append((row[index], index, np.full(len(index), search, np.int32), key))
    at, index, search, key = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(at, kind="stable")
    return at[order], index[order], search[order], key[order]


HIT = "array<struct<search: int, key: long, at: int>>"


def _near(at: np.ndarray, n: int, reach: int) -> np.ndarray:
    """Which of ``n`` words lie within ``reach`` of the places ``at``."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, np.maximum(at - reach, 0), 1)
    np.add.at(change, np.minimum(at + reach + 1, n), -1)
    return np.cumsum(change[:-1]) > 0


def _document_task(wanted: dict[int, np.ndarray], places: np.ndarray, reach: int, hit: bool):
    """Rows whose keys pass, numbered, with their words' hashes and hits; or, of
    the others, the rows alone. Words out of reach of all hits are left blank."""
    kind = pa.list_(pa.struct([("search", pa.int32()), ("key", pa.int64()), ("at", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, "text"):
                h, row = word_hashes(*utf8(part.column("text")))
                n = np.bincount(row, minlength=part.num_rows)
                begin = np.concatenate([[0], np.cumsum(n)])
                at, index, search, key = _hits(h, row, wanted, places) if len(h) else (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
                some, first = np.unique(at, return_index=True)
                if not hit:
                    clean = np.ones(part.num_rows, bool)
                    clean[some] = False
                    yield pa.RecordBatch.from_arrays([part.column("row").filter(pa.array(clean))], ["row"])
                    continue
                rows = pa.array(some)
                parts = pa.StructArray.from_arrays([pa.array(search.astype(np.int32)), pa.array(signed(key)), pa.array((index - begin[at]).astype(np.int32))],
                                                   ["search", "key", "at"])
                hits = pa.ListArray.from_arrays(pa.array(np.append(first, len(at)).astype(np.int32)), parts).cast(kind)
                kept = np.where(_near(index, len(h), reach), h, _END)
                hashes = pa.array([kept[begin[i]:begin[i + 1]].tobytes() for i in some.tolist()], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("row").take(rows), hashes, hits, pa.array(uid + np.arange(len(some)))],
                                                 ["row", "words", "hits", "uid"])
                uid += len(some)
    return run


def _verify_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw = batch.column("words").to_pylist()
        row = np.repeat(np.arange(len(raw)), [len(x) // 8 for x in raw])
        begin = np.concatenate([[0], np.cumsum([len(x) // 8 for x in raw])])
        number: dict[int, int] = {}
        hashes, edits, doc, item, diagonal = [], [], [], [], []
        for i, candidates in enumerate(batch.column("items").to_pylist()):
            for c in candidates:
                k = number.setdefault(c["item"], len(number))
                if k == len(hashes):
                    hashes.append(np.frombuffer(c["pattern"], np.uint64))
                    edits.append(c["edits"])
                doc += [i] * len(c["diagonals"])
                item += [k] * len(c["diagonals"])
                diagonal += [d + int(begin[i]) for d in c["diagonals"]]
        h = np.frombuffer(b"".join(raw), np.uint64)
        rows = Patterns(hashes, np.array(edits, np.int64)).verified(h, row, *(np.array(x, np.int64) for x in (doc, item, diagonal)))
        names = np.array(list(number), np.int64)
        n_words = np.array([len(x) for x in hashes], np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("uid").take(pa.array(rows[:, 0])), pa.array(names[rows[:, 1]]),
                                          *(pa.array(x.astype(np.int32)) for x in (rows[:, 2], n_words[rows[:, 1]], rows[:, 3]))],
                                         ["uid", "item", "distance", "item_words", "start_word"])


def _matches(found: DataFrame, bench: _Benchmark) -> DataFrame:
    """``uid, item, distance, item_words, start_word`` of the documents
    ``uid, words, hits``."""
    salt = F.pmod(F.xxhash64("uid"), F.lit(SALTS)).cast("int").alias("salt")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    hits = found.select("uid", salt, F.explode("hits").alias("hit")).select("uid", "salt", "hit.search", "hit.key", "hit.at")
    keys = bench.keys.select("search", "key", "item", "anchor", "edits", salts)
    step = F.greatest("edits", F.lit(1))
    # neighbouring diagonals are verified as one: its window covers them all
    diagonal = F.floor((F.col("at") - F.col("anchor")) / step) * step
    met = (hits.join(keys, ["search", "key", "salt"]).select("uid", "salt", "item", diagonal.cast("int").alias("diagonal"))
           .groupBy("uid", "salt", "item").agg(F.collect_set("diagonal").alias("diagonals")))  # of one document and item
    items = bench.items.select("item", F.col("words").alias("pattern"), "edits", salts)
    wanted = (met.join(items, ["item", "salt"]).groupBy("uid")
              .agg(F.collect_list(F.struct("item", "pattern", "edits", "diagonals")).alias("items")))  # of one document
    return (found.select("uid", "words").join(wanted, "uid")
            .mapInArrow(_verify_task, "uid long, item long, distance int, item_words int, start_word int"))


def _found(rows: DataFrame, bench: _Benchmark) -> tuple[DataFrame, DataFrame]:
    """The rows (``row, text``) whose keys pass (``row, words, hits, uid``), and
    the others (``row``)."""
    kind = rows.schema["row"].dataType.simpleString()
    longest = bench.items.agg(F.max("n_words")).first()[0]
    reach = longest + 8 * int(allowed_edits(np.array([longest]), bench.max_edits)[0]) + 8  # no window goes further

    def task(hit: bool):
        return _document_task(bench.wanted, bench.places, reach, hit)

    return (saved(rows.mapInArrow(task(True), f"row {kind}, words binary, hits {HIT}, uid long"), "decontaminate", "found"),
            rows.mapInArrow(task(False), f"row {kind}"))


def leaks(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          item_id_col: str = "item_id", item_text_col: str = "text", max_edits: float = MAX_EDITS,
          broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """``id_col, item_id, distance, item_words, start_word`` for every document
    row and item that it holds."""
    bench = _Benchmark(benchmark, item_id_col, item_text_col, max_edits, broadcast_words)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    if bench.small:
        schema = f"id {rows.schema['id'].dataType.simpleString()}, item_id {bench.id_type}, distance int, item_words int, start_word int"
        id_type = to_arrow_type(benchmark.schema[item_id_col].dataType)
        return rows.mapInArrow(_leak_task(bench.ids, bench.hashes, max_edits, id_type), schema).withColumnRenamed("id", id_col)
    found, _ = _found(rows.select(F.struct("id").alias("row"), "text"), bench)
    # a common item is in many documents: its id is joined by salted keys, too
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    return (_matches(found, bench).join(found.select("uid", F.col("row.id").alias("id")), "uid")
            .withColumn("salt", F.pmod(F.xxhash64("uid"), F.lit(SALTS)).cast("int"))
            .join(bench.items.select("item", "item_id", salts), ["item", "salt"])
            .select(F.col("id").alias(id_col), "item_id", "distance", "item_words", "start_word"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  max_edits: float = MAX_EDITS, broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item, all columns kept.
    The judgement is made row by row, so no id has to be unique."""
    bench = _Benchmark(benchmark, "item_id", "text", max_edits, broadcast_words)
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(f"`{text_col}`").alias("text"))
    if bench.small:
        kind = rows.schema["row"].dataType.simpleString()
        return rows.mapInArrow(_clean_task(bench.hashes, max_edits), f"row {kind}").select("row.*")
    found, others = _found(rows, bench)
    leaking = _matches(found, bench).select("uid").distinct()
    return others.unionByName(found.join(leaking, "uid", "left_anti").select("row")).select("row.*")
