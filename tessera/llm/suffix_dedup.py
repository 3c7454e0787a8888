"""Suffix-array dedup: remove every byte that a repeated long string covers.

Texts are UTF-8 bytes. A byte goes if a string of ``LENGTH`` bytes that covers
it also starts anywhere else, in the same text or another; strings never cross
texts and are judged on the input. The result is exact.

*Anchors.* A repeated string is found by its anchor: of all ``depth``-byte
strings inside it the one with the smallest hash (leftmost on ties). Equal
strings have equal anchors, neighbouring strings mostly share one, so a text
becomes a few runs ``(anchor, start, length)`` of string starts. Anchors that
occur once are dropped by a count; only for the rest is anything compared.

*Classes.* Runs with equal anchor and equal bytes are copies: all their strings
are repeated. Of each class one run goes on, as the comparand of the other
classes of its anchor, so a text copied a thousand times is handled once.

*Interval expansion.* The classes of whole anchors are concatenated in blocks
of ``BLOCK_BYTES``. Of a block only the strings whose deeper anchor (``NARROW`` of
``LENGTH`` bytes) recurs in it go on: equal strings share that anchor too. The
suffixes left are sorted as deep as needed and give the block's Burrows-Wheeler
transform; breadth-first backward extension of intervals
derives the longest common prefixes in increasing order, and stops at
``LENGTH``: the prefixes still open then are the repeated strings.

*Hot anchors.* An anchor with more than ``HOT_CLASSES`` classes (a passage in a
third of all texts, with other text around it each time) is never gathered: its
classes get deeper anchors, which tell most of them apart, level by level up to
``LENGTH`` itself, where equal anchors are equal strings and a count decides.
Joins of runs salt the keys of many rows (``hotkeys.py``), so the rows of one
passage are spread over tasks.

Defined results: null counts as empty; texts shorter than ``LENGTH`` stay
whole; rows with equal text, repeated rows included, are copies of each other
(so all go, also the first). Rows are told apart by id and a digest of the text
(128 bits); a null id is an id like any other. An empty table gives an empty result. Only
the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import saved
from .hotkeys import join_counted
from .textarrays import BYTE_VALUE_2, SpanHash, mix, signed, slices, utf8

LENGTH = 400
DEPTHS = (128, 280, 340, 370, 385, 393, 397, 400)
HOT_CLASSES = 1000
BLOCK_BYTES = 500_000
RUN_BYTES = 1_000_000
NARROW = 0.9


def depths_for(length: int) -> tuple[int, ...]:
    """Anchor depths up to ``length``, each leaving half the room of the one before."""
    out = [max(1, length * 32 // 100)]
    while out[-1] < length:
        out.append(length - (length - out[-1]) // 2 if length - out[-1] > 1 else length)
    return tuple(out)


def anchor_runs(data: np.ndarray, offsets: np.ndarray, depth: int, length: int):
    """``(row, start, count, anchor, content)`` of every run of string starts
    with one anchor: ``count`` strings from ``start`` on, counted from the
    row's beginning; hashes of the anchor and of all bytes of the run."""
    n = len(data)
    width = length - depth + 1  # anchor candidates in one string
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    span = SpanHash(data)
    at = np.arange(n - depth + 1)
    bits = max(22, int(n).bit_length())
    least = (span(at, at + depth) >> np.uint64(bits) << np.uint64(bits)) | at.astype(np.uint64)
    size = 1
    while size * 2 <= width:  # minima over windows of 1, 2, 4, ... candidates
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < width:
        least = np.minimum(least[:len(least) - (width - size)], least[width - size:])
    # strings that end beyond their row don't count
    first = np.zeros(n - length + 1, np.int64)
    whole = np.diff(offsets) >= length
    begin, end = offsets[:-1][whole], offsets[1:][whole] - length + 1
    marks = np.zeros(n - length + 2, np.int64)
    marks[begin] += 1
    marks[end] -= 1
    start = np.flatnonzero(np.cumsum(marks[:-1]) > 0)
    del first
    if not len(start):
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    anchor = (least[start] & np.uint64((1 << bits) - 1)).astype(np.int64)
    row = np.searchsorted(offsets, start, side="right") - 1
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    head = np.flatnonzero(new)
    count = np.diff(np.append(head, len(start)))
    lo, a, row = start[head], anchor[head], row[head]
    content = mix(SpanHash(data, BYTE_VALUE_2)(lo, lo + count - 1 + length) ^ mix((a - lo).astype(np.uint64) + np.uint64(7)))
    return row, lo - offsets[row], count, span(a, a + depth), content


# --- longest common prefixes of one block -------------------------------------

def sorted_suffixes(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffix order by the first ``depth`` symbols at least, by rank doubling.
    ``text`` holds integers below 512 and ends with its only 0. Only suffixes
    whose rank is shared are sorted again."""
    n = len(text)
    padded = np.concatenate([text.astype(np.uint64), np.zeros(7, np.uint64)])
    key = np.zeros(n, np.uint64)
    for k in range(7):  # nine bits a symbol: bytes and the end marks
        key = (key << np.uint64(9)) | padded[k:n + k]
    order = np.argsort(key)
    place, of_key = np.arange(n), key[order]  # a group's rank is the place of its first member
    rank = np.empty(n, np.int64)
    known = 7
    while True:
        new = np.ones(len(place), bool)
        new[1:] = of_key[1:] != of_key[:-1]
        rank[order[place]] = place[np.maximum.accumulate(np.where(new, np.arange(len(place)), 0))]
        shared = ~new
        shared[:-1] |= ~new[1:]
        place = place[shared]
        if known >= depth or not len(place):
            return order
        some = order[place]
        # a suffix that shares its rank is longer than ``known``: the end mark is unique
        of_key = rank[some] * n + rank[some + known]
        by = np.argsort(of_key)
        order[place], of_key = some[by], of_key[by]
        known *= 2


def open_prefixes(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array, and for every place of it whether its suffix shares
    ``length`` symbols or more with the one before.

    Level by level, the interval of every string w in the queue is extended by
    each symbol c before it (the transform's symbols in the interval); the last
    row of the interval of cw borders on a suffix that shares only |w| symbols.
    A border found for the first time is closed, and cw goes into the next
    level's queue. Borders open after ``length`` levels share ``length`` symbols.
    """
    n = len(text)
    order = sorted_suffixes(text, length)
    before = text[order - 1]  # the transform; the end mark stands before the whole text
    # the row of the suffix that is one symbol longer
    step = np.empty(n, np.int64)
    step[np.argsort(before, kind="stable")] = np.arange(n)
    open_ = np.ones(n + 1, bool)
    open_[0] = open_[n] = False
    lo, hi = np.array([0]), np.array([n - 1])
    for _ in range(length):
        sizes = hi - lo + 1
        owner = np.repeat(np.arange(len(lo)), sizes)
        rows = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + lo[owner]
        if not len(rows):
            break
        target = step[rows]
        by = np.argsort(target, kind="stable")
        target, owner, symbol = target[by], owner[by], before[rows][by]
        edge = np.ones(len(target), bool)
        edge[1:] = (owner[1:] != owner[:-1]) | (symbol[1:] != symbol[:-1])
        heads = np.flatnonzero(edge)
        tails = np.append(heads[1:], len(target)) - 1
        border = target[tails] + 1
        fresh = open_[border]
        open_[border[fresh]] = False
        lo, hi = target[heads[fresh]], target[tails[fresh]]
    return order, open_[:n]


def repeated_starts(parts: list[np.ndarray], length: int) -> list[np.ndarray]:
    """For each byte string, the starts whose ``length`` bytes stand anywhere
    else among the strings."""
    sizes = np.array([len(p) for p in parts])
    begin = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    # 1 ends every string, a single 0 the text: bytes follow from 2
    text = np.ones(int((sizes + 1).sum()) + 1, np.int64)
    text[-1] = 0
    text[np.repeat(begin, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = np.concatenate(parts).astype(np.int64) + 2
    order, shared = open_prefixes(text, length)
    found = np.zeros(len(text), bool)
    at = np.flatnonzero(shared)
    found[order[at]] = True
    found[order[at - 1]] = True
    return [np.flatnonzero(found[b:b + max(s - length + 1, 0)]) for b, s in zip(begin.tolist(), sizes.tolist(), strict=True)]


def narrowed(parts: list[np.ndarray], length: int) -> list[tuple[int, int, int]]:
    """``(part, first, last)`` runs of string starts that may be repeated: those
    whose deep anchor stands in another run too."""
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    row, start, count, anchor, _ = anchor_runs(np.concatenate(parts), offsets, max(1, int(length * NARROW)), length)
    _, which, times = np.unique(anchor, return_inverse=True, return_counts=True)
    kept = times[which] > 1
    out: list[list[int]] = []
    for r, a, b in zip(row[kept].tolist(), start[kept].tolist(), (start + count - 1)[kept].tolist(), strict=True):
        if out and out[-1][0] == r and out[-1][2] == a - 1:
            out[-1][2] = b  # neighbouring runs are one span
        else:
            out.append([r, a, b])
    return [tuple(x) for x in out]


# --- Spark steps --------------------------------------------------------------

def _text_key(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _run_task(depth: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", RUN_BYTES):
                row, start, count, anchor, content = anchor_runs(*utf8(part.column("text")), depth, length)
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(anchor)), pa.array(signed(content)), part.column("id").take(at), part.column("t").take(at),
                     pa.array(start.astype(np.int32)), pa.array(count.astype(np.int32))], ["anchor", "content", "id", "t", "start", "count"])
            pa.default_memory_pool().release_unused()
    return run


def _cut_task(length: int):
    """Bytes of the wanted runs of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anchor, content, many, off, raw = [], [], [], [], []
            for text, runs in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist(), strict=True):
                data = text.encode("utf-8", "surrogatepass")
                for r in runs:
                    anchor.append(r["anchor"])
                    content.append(r["content"])
                    many.append(r["classes"])
                    off.append(0)
                    raw.append(data[r["start"]:r["start"] + r["count"] - 1 + length])
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor, pa.int64()), pa.array(content, pa.int64()), pa.array(anchor, pa.int64()), pa.array(many, pa.int64()),
                 pa.array(off, pa.int32()), pa.array(raw, pa.binary())], ["anchor", "content", "unit", "classes", "off", "bytes"])
    return run


def _deeper_task(depth: int, length: int):
    """Runs of deeper anchors within the spans of hot anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                raw = part.column("bytes").to_pylist()
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
                data = np.frombuffer(b"".join(raw), np.uint8)
                row, start, count, anchor, content = anchor_runs(data, offsets, depth, length)
                rows = pa.array(row)
                lo = offsets[row] + start
                cut = [bytes(data[a:b]) for a, b in zip(lo.tolist(), (lo + count - 1 + length).tolist(), strict=True)]
                off = part.column("off").to_numpy()[row] + start
                yield pa.RecordBatch.from_arrays(
                    [part.column("anchor").take(rows), part.column("content").take(rows), pa.array(signed(anchor)), pa.array(signed(content)),
                     pa.array(off.astype(np.int32)), pa.array(count.astype(np.int32)), pa.array(cut, pa.binary())],
                    ["anchor", "content", "unit", "sub", "off", "count", "bytes"])
    return run


def _expand_task(length: int):
    """Interval expansion over blocks of whole anchors (rows come sorted by unit)."""
    def block(held: list) -> pa.RecordBatch:
        texts = [np.frombuffer(h[3], np.uint8) for h in held]
        some = narrowed(texts, length)
        starts = repeated_starts([texts[r][a:b + length] for r, a, b in some], length) if some else []
        out: list[tuple] = []
        for (r, a, _), s in zip(some, starts, strict=True):
            if len(s):
                anchor, content, off, _ = held[r]
                s = s + a
                cut = np.flatnonzero(np.diff(s) > 1)
                out += [(anchor, content, off + int(a), off + int(b)) for a, b in zip(s[np.append(0, cut + 1)], s[np.append(cut, len(s) - 1)], strict=True)]
        columns = list(zip(*out, strict=True)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)],
                                          ["anchor", "content", "first", "last"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, unit = [], 0, None
        for batch in batches:
            for u, anchor, content, off, raw in zip(*(batch.column(c).to_pylist() for c in ("unit", "anchor", "content", "off", "bytes")), strict=True):
                if u != unit and size > BLOCK_BYTES:
                    yield block(held)
                    held, size = [], 0
                unit = u
                held.append((anchor, content, off, raw))
                size += len(raw) + 1
        if held:
            yield block(held)
    return run


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").alias("id"), _text_key(text).alias("t"), text.alias("text"))


def repeated_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   hot_classes: int = HOT_CLASSES) -> DataFrame:
    """``id, t, spans``: for every text with repeated strings the array of
    ``(first, last)`` starts of such strings (they may touch or overlap)."""
    depths = DEPTHS if length == LENGTH else depths_for(length)
    rows = _rows(docs, id_col, text_col)
    long = rows.where(F.octet_length("text") >= length)
    id_type = rows.schema["id"].dataType.simpleString()
    runs = saved(long.mapInArrow(_run_task(depths[0], length), f"anchor long, content long, id {id_type}, t binary, start int, count int"),
                 "suffix_dedup", "runs")
    n_runs = runs.count()
    classes = saved(runs.groupBy("anchor", "content")
                    .agg(F.count(F.lit(1)).alias("n"), F.min("count").alias("count"), F.min(F.struct("id", "t", "start")).alias("one")),
                    "suffix_dedup", "classes")
    several = saved(classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("classes")).where("classes > 1"), "suffix_dedup", "several")
    wanted = (join_counted(classes, several, ["anchor"], "classes", n_runs, F.col("content"))
              .groupBy(F.col("one.id").alias("w_id"), F.col("one.t").alias("w_t"))
              .agg(F.collect_list(F.struct("anchor", "content", "classes", F.col("one.start").alias("start"), "count")).alias("runs")))
    spans = saved(long.join(wanted, long["id"].eqNullSafe(wanted["w_id"]) & (long["t"] == wanted["w_t"])).select("text", "runs")
                  .mapInArrow(_cut_task(length), "anchor long, content long, unit long, classes long, off int, bytes binary")
                  .dropDuplicates(["anchor", "content"]), "suffix_dedup", "spans")
    found = _compared(spans, depths[1:], length, hot_classes)
    copied = classes.where("n > 1").select("anchor", "content", "n", F.lit(0).alias("first"), (F.col("count") - 1).alias("last"))
    part = found.join(copied.select("anchor", "content"), ["anchor", "content"], "left_anti").withColumn("n", F.lit(1).cast("long"))
    marks = saved(copied.unionByName(part).groupBy("anchor", "content").agg(F.max("n").alias("n"), F.collect_list(F.struct("first", "last")).alias("marks")),
                  "suffix_dedup", "marks")
    return (join_counted(runs, marks, ["anchor", "content"], "n", n_runs, F.xxhash64("t", "start"))
            .select("id", "t", "start", F.explode("marks").alias("mark"))
            .groupBy("id", "t")
            .agg(F.collect_list(F.struct((F.col("start") + F.col("mark.first")).alias("first"),
                                         (F.col("start") + F.col("mark.last")).alias("last"))).alias("spans")))


def _compared(spans: DataFrame, depths: tuple[int, ...], length: int, hot_classes: int) -> DataFrame:
    """``anchor, content, first, last`` of the repeated strings of the classes
    in ``spans``, each ``unit`` of which holds several classes."""
    schema = "anchor long, content long, first int, last int"
    cold = (spans.where(F.col("classes") <= hot_classes).select("unit", "anchor", "content", "off", "bytes")
            .repartition("unit").sortWithinPartitions("unit"))
    found = cold.mapInArrow(_expand_task(length), schema)
    hot = spans.where(F.col("classes") > hot_classes)
    if not depths or not hot.limit(1).count():
        return found
    deeper = saved(hot.mapInArrow(_deeper_task(depths[0], length),
                                  "anchor long, content long, unit long, sub long, off int, count int, bytes binary"), "suffix_dedup", "deeper")
    subs = saved(deeper.groupBy("unit", "sub").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("anchor", "content", "off")).alias("one")),
                 "suffix_dedup", "subs")
    copies = (deeper.drop("bytes").join(subs.where("n > 1").select("unit", "sub"), ["unit", "sub"], "left_semi")
              .select("anchor", "content", F.col("off").alias("first"), (F.col("off") + F.col("count") - 1).alias("last")))
    several = subs.groupBy("unit").agg(F.count(F.lit(1)).alias("classes")).where("classes > 1")
    ones = (subs.join(several, "unit")
            .select("unit", "sub", "classes", F.col("one.anchor").alias("anchor"), F.col("one.content").alias("content"), F.col("one.off").alias("off")))
    following = saved(deeper.join(ones, ["unit", "sub", "anchor", "content", "off"])
                      .select("anchor", "content", "unit", "classes", "off", "bytes"), "suffix_dedup", "spans")
    return found.unionByName(copies).unionByName(_compared(following, depths[1:], length, hot_classes))


def dedup_suffixes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   hot_classes: int = HOT_CLASSES) -> DataFrame:
    """``id_col, n_bytes, removed`` (array of ``(start, end)`` byte spans) and
    ``kept`` (the remaining bytes, concatenated) of every row."""
    rows = _rows(docs, id_col, text_col)
    spans = repeated_spans(docs, id_col=id_col, text_col=text_col, length=length, hot_classes=hot_classes)
    spans = spans.select(F.col("id").alias("s_id"), F.col("t").alias("s_t"), "spans")
    joined = rows.join(spans, rows["id"].eqNullSafe(spans["s_id"]) & (rows["t"] == spans["s_t"]), "left").select("id", "text", "spans")
    kind = rows.schema["id"].dataType.simpleString()
    return (joined.mapInArrow(_remove_task(length), f"id {kind}, n_bytes long, removed array<struct<start: int, end: int>>, kept binary")
            .withColumnRenamed("id", id_col))


def _remove_task(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            for part in slices(batch, "text"):
                removed, kept, sizes = [], [], []
                for text, spans in zip(part.column("text").to_pylist(), part.column("spans").to_pylist(), strict=True):
                    data = text.encode("utf-8", "surrogatepass")
                    gone, rest, at = [], [], 0
                    for first, last in sorted((s["first"], s["last"] + length) for s in spans or ()):
                        if gone and first <= gone[-1][1]:
                            gone[-1][1] = max(gone[-1][1], last)
                        else:
                            gone.append([first, last])
                    for first, last in gone:
                        rest.append(data[at:first])
                        at = last
                    rest.append(data[at:])
                    sizes.append(len(data))
                    removed.append([{"start": a, "end": b} for a, b in gone])
                    kept.append(b"".join(rest))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(sizes, pa.int64()), pa.array(removed, kind), pa.array(kept, pa.binary())],
                                                 ["id", "n_bytes", "removed", "kept"])
    return run
