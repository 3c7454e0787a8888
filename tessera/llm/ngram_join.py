"""N-gram Jaccard join: MinHash LSH forest, then exact verification.

Two documents are linked when the Jaccard similarity of their sets of word
5-grams is 0.8 or more. The steps:

1. Documents with the same words in the same order are *copies*; one signature
   of ``N_MINS`` minima is kept for each such class of copies.
2. Prefix trees are laid over the signatures; a tree orders some of
   the minima, and two classes meet in it at depth d when their first d values
   agree. The search starts with long prefixes in ``LONG_TREES`` trees, where only
   close texts meet: every bucket links its members to its smallest one, signature estimates
   discard chance meetings, and the components of these links contract the
   large groups.
3. In all ``TREES`` trees the signatures are sorted by their values in the
   tree's order, which makes them a prefix trie: members of a node are
   neighbours, and the common prefix of neighbours tells at which depth they
   part. A task holds whole subtries, below the shortest prefix that is needed;
   from the longest prefixes on it shortens them step by step, compares the
   members that meet at a depth for the first time and are not yet of one
   component, by the same estimate, and joins components (a large subtrie in
   pairs of blocks). The shortest prefix is the longest one whose recall at the
   threshold reaches ``recall``, measured by drawing the minima that a pair
   agrees in and following them through the trees as they are (``prefix_recall``:
   the trees share minima, so they are not independent).
4. Within each component every pair is verified exactly on its sets of 5-gram
   hashes (64 bits). A large component is cut into blocks of ``BLOCK`` classes
   and each pair of blocks is a task of its own, so no task holds more than
   two blocks and no pair is ever a row.

The result has one row per document, with the number of links and the class of
near duplicates (connected component of verified links); pairs are never listed.

Words are separated by ASCII white space. Defined results: a text of one to
four words has one n-gram, the whole; a text without words (null, empty, blank)
has no links, is no copy of another, and is a class of its own. Repeated rows
and repeated doc_ids are copies or documents like any other row; a null doc_id
stays null. An empty table gives an empty result. Only the id and text columns
are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import saved
from .components import connected_components
from .textarrays import SpanHash, mix, signed, slices, utf8, words

WORDS = 5
THRESHOLD = 0.8
N_MINS = 128
TREES = 32
#: The first search: few trees and long prefixes, for the closest texts only.
LONG_TREES = 8
LONG_PREFIX = 14
#: Values behind the shortest prefix that order a subtrie.
BELOW = 8
RECALL = 0.999
BLOCK = 512
#: Pairs whose signatures agree less are not verified: over five standard
#: errors below the threshold.
LEAST_ESTIMATE = 0.6

_random = np.random.default_rng(4242)
_FACTOR = _random.integers(1, 1 << 63, N_MINS, dtype=np.uint64) | np.uint64(1)
_SHIFT = _random.integers(0, 1 << 63, N_MINS, dtype=np.uint64)
_PLACE = _random.integers(1, 1 << 63, WORDS, dtype=np.uint64) | np.uint64(1)
_TREE_ORDER = np.array([_random.permutation(N_MINS) for _ in range(TREES)])


@cache
def prefix_recall(threshold: float, trees: int, draws: int = 100_000) -> tuple[float, ...]:
    """Share of pairs of similarity ``threshold`` that meet in one of the trees
    at depth 0, 1, ... ``LONG_PREFIX``."""
    random = np.random.default_rng(99)
    deepest = np.zeros(draws, np.int64)
    for lo in range(0, draws, 10_000):
        agree = random.random((len(deepest[lo:lo + 10_000]), N_MINS)) < threshold
        for t in range(trees):
            path = agree[:, _TREE_ORDER[t, :LONG_PREFIX]]
            deepest[lo:lo + 10_000] = np.maximum(deepest[lo:lo + 10_000], np.where(path.all(1), LONG_PREFIX, path.argmin(1)))
    return tuple(float((deepest >= d).mean()) for d in range(LONG_PREFIX + 1))


def prefix_depth(threshold: float = THRESHOLD, trees: int = TREES, recall: float = RECALL) -> int:
    """The longest prefix at which ``trees`` trees find a pair of similarity
    ``threshold`` with probability ``recall``."""
    return max(d for d, r in enumerate(prefix_recall(threshold, trees)) if r >= recall or d <= 1)


def document_shingles(data: np.ndarray, offsets: np.ndarray):
    """``(hash, row)`` of every 5-gram occurrence and two 64-bit digests of
    each row's word sequence (0 for rows without words)."""
    n = len(offsets) - 1
    start, end, row = words(data, offsets)
    h = SpanHash(data)(start, end)
    count = np.bincount(row, minlength=n)
    first = np.concatenate([[0], np.cumsum(count)])[:-1]
    place = (np.arange(len(h)) - first[row]).astype(np.uint64)
    digests = [np.zeros(n, np.uint64), np.zeros(n, np.uint64)]
    some = np.flatnonzero(count)
    if len(some):
        for out, salt in zip(digests, (0x51ED270B, 0x2545F491), strict=True):
            out[some] = np.add.reduceat(mix(h ^ mix(place + np.uint64(salt << 20))), first[some])
    full = place.astype(np.int64) + WORDS <= count[row]
    at = np.flatnonzero(full)
    shingle = np.zeros(len(at), np.uint64)
    for k in range(WORDS):
        shingle += h[at + k] * _PLACE[k]
    short = np.flatnonzero((count > 0) & (count < WORDS))  # the whole text is the one n-gram
    hashes = np.concatenate([mix(shingle), mix(digests[0][short] + np.uint64(1))])
    rows = np.concatenate([row[at], short])
    if len(short):
        order = np.argsort(rows, kind="stable")
        hashes, rows = hashes[order], rows[order]
    return hashes, rows, digests


def _binary(a: np.ndarray) -> pa.Array:
    """Rows of a 2-d array as binary values."""
    raw = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1)
    offsets = np.arange(len(a) + 1, dtype=np.int32) * raw.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(a), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])


def _digest(digests) -> pa.Array:
    return _binary(np.column_stack(digests))


def _sketch_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            hashes, rows, digests = document_shingles(*utf8(part.column("text")))
            some, first = np.unique(rows, return_index=True)
            if not len(some):
                continue
            mins = np.empty((len(some), N_MINS), np.uint32)
            for i in range(N_MINS):
                mins[:, i] = np.minimum.reduceat(hashes * _FACTOR[i] + _SHIFT[i], first) >> np.uint64(32)
            yield pa.RecordBatch.from_arrays(
                [_digest([d[some] for d in digests]), part.column("id").take(pa.array(some)), _binary(mins),
                 _binary(mins.astype(np.uint8))], ["digest", "id", "mins", "sketch"])


def _digest_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            _, _, digests = document_shingles(*utf8(part.column("text")))
            yield pa.RecordBatch.from_arrays([_digest(digests), *part.columns], ["digest", *part.schema.names])


def _tree_task(depth: int, trees: int):
    """Per tree the key of a prefix of ``depth`` values, and a byte of each of
    the ``BELOW`` values that follow it: their order is that of the trie."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                n = part.num_rows
                mins = np.frombuffer(b"".join(part.column("mins").to_pylist()), np.uint32).reshape(n, N_MINS).astype(np.uint64)
                keys, below = np.empty((n, trees), np.uint64), np.zeros((n, trees), np.uint64)
                for t in range(trees):
                    key = np.full(n, t + 1, np.uint64)
                    for i in _TREE_ORDER[t, :depth]:
                        key = mix(key ^ mix(mins[:, i] + np.uint64(1)))
                    keys[:, t] = key
                    for i in _TREE_ORDER[t, depth:depth + BELOW]:
                        below[:, t] = (below[:, t] << np.uint64(8)) | (mix(mins[:, i] + np.uint64(3)) >> np.uint64(56))
                again = pa.array(np.repeat(np.arange(n), trees))
                yield pa.RecordBatch.from_arrays([pa.array(signed(keys.ravel())), pa.array(signed(below.ravel())), part.column("node").take(again),
                                                  part.column("component").take(again)], ["key", "below", "node", "component"])
    return run


def _sketches(column: pa.Array) -> np.ndarray:
    """One byte of every minimum: unequal minima agree in it by a chance of 1/256."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), N_MINS)


def _agreeing(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The ``a, b`` pairs whose signatures agree well enough."""
    sketch = classes.select(F.col("node").alias("a"), F.col("sketch").alias("sketch_a"))
    both = (pairs.join(sketch, "a")
            .join(sketch.select(F.col("a").alias("b"), F.col("sketch_a").alias("sketch_b")), "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            agree = (_sketches(batch.column("sketch_a")) == _sketches(batch.column("sketch_b"))).mean(1)
            yield batch.filter(pa.array(agree >= LEAST_ESTIMATE)).select(["a", "b"])

    return both.select("a", "b", "sketch_a", "sketch_b").mapInArrow(run, "a long, b long")


def _bridge_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Components that agreeing pairs of a subtrie join, each with the smallest
    that it hangs together with there (rows come sorted by the trie's order)."""
    for parts in _units(batches, ("bucket", "kind", "i", "j")):
        table = pa.Table.from_batches(parts)
        block = None
        if table.column("kind")[0].as_py() == 0 or table.column("i")[0].as_py() != table.column("j")[0].as_py():
            block = table.column("in_i").to_numpy(zero_copy_only=False).astype(bool)  # pairs within a block are that block's own
        names, component = np.unique(table.column("component").to_numpy(), return_inverse=True)
        if len(names) > 1:
            label = joined_components(table.column("below").to_numpy().view(np.uint64), component, _sketches(table.column("sketch").combine_chunks()), block)
            moved = label != np.arange(len(names))
            yield pa.RecordBatch.from_arrays([pa.array(names[label[moved]]), pa.array(names[moved])], ["a", "b"])


def common_levels(below: np.ndarray) -> np.ndarray:
    """Levels below the subtrie's top that each member shares with the next."""
    differ = below[1:] ^ below[:-1]
    return sum((differ >> np.uint64(8 * (BELOW - k)) == 0).astype(np.int64) for k in range(1, BELOW + 1))


def joined_components(below: np.ndarray, component: np.ndarray, sketch: np.ndarray, block: np.ndarray | None) -> np.ndarray:
    """For every component (0, 1, ...) the smallest that it hangs together with.

    From the longest common prefix of neighbours to the shortest, the trie's
    nodes at that depth are runs of members, made of the runs one level below;
    members of different runs meet there for the first time.
    """
    label = np.arange(int(component.max()) + 1)
    shared = common_levels(below)
    for level in np.unique(shared)[::-1].tolist():
        node = np.concatenate([[0], np.cumsum(shared < level)])
        child = np.concatenate([[0], np.cumsum(shared <= level)])
        cut = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
        for lo, hi in zip(cut.tolist(), [*cut[1:].tolist(), len(node)], strict=True):
            if hi - lo < 2 or child[lo] == child[hi - 1]:
                continue
            mine, place = np.unique(label[component[lo:hi]], return_inverse=True)
            if len(mine) < 2:
                continue
            linked = np.zeros((len(mine), len(mine)), bool)
            for at in range(lo, hi, 32):
                some = slice(at, min(at + 32, hi))
                wanted = (place[some.start - lo:some.stop - lo, None] != place[None, :]) & (child[some, None] < child[None, lo:hi])
                if block is not None:
                    wanted &= block[some, None] != block[None, lo:hi]
                x, y = np.nonzero(wanted)
                if len(x):
                    good = (sketch[some][x] == sketch[lo:hi][y]).mean(1) >= LEAST_ESTIMATE
                    x, y = place[some.start - lo:some.stop - lo][x[good]], place[y[good]]
                    linked[x, y] = linked[y, x] = True
            root = mine[_smallest_linked(linked)]
            if (root != mine).any():
                moved = np.arange(len(label))
                moved[mine] = root
                label = moved[label]
    return label


def _smallest_linked(linked: np.ndarray) -> np.ndarray:
    """Per row of a symmetric link matrix the smallest row it hangs together with."""
    label = np.arange(len(linked))
    while True:
        spread = np.minimum(label, np.where(linked, label[None, :], len(linked)).min(1, initial=len(linked)))
        spread = spread[spread]
        if (spread == label).all():
            return label
        label = spread


def candidate_components(classes: DataFrame, threshold: float, recall: float, block: int) -> DataFrame:
    """``node, component`` of the classes that may be linked to another."""
    alone = classes.select("node", "mins", F.col("node").alias("component"))
    schema = "key long, below long, node long, component long"
    members = alone.mapInArrow(_tree_task(LONG_PREFIX, LONG_TREES), schema).select("key", "node")
    pivots = members.groupBy("key").agg(F.min("node").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    stars = members.join(pivots, "key").where("a <> node").select("a", F.col("node").alias("b")).distinct()
    close = connected_components(_agreeing(stars, classes))

    placed = (classes.select("node", "mins").join(close, "node", "left")
              .select("node", "mins", F.coalesce("component", "node").alias("component"), F.col("component").isNotNull().alias("close")))
    shorter = placed.select("node", "mins", "component").mapInArrow(_tree_task(prefix_depth(threshold, TREES, recall), TREES), schema)
    mixed = (shorter.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
             .where("lo < hi").select("key"))
    # the pairs of a subtrie are compared where its members meet: only agreeing ones become rows
    subtries = saved(shorter.join(mixed, "key").withColumnRenamed("key", "bucket"), "ngram_join", "subtries")
    bridges = (_meetings(subtries, block).join(classes.select("node", "sketch"), "node")
               .repartition("bucket", "kind", "i", "j").sortWithinPartitions("bucket", "kind", "i", "j", "below")
               .mapInArrow(_bridge_task, "a long, b long").distinct())
    merged = connected_components(bridges).select(F.col("node").alias("component"), F.col("component").alias("merged"))
    return (placed.select("node", "component", "close").join(merged, "component", "left")
            .where(F.col("close") | F.col("merged").isNotNull())
            .select("node", F.coalesce("merged", "component").alias("component")))


def _meetings(members: DataFrame, block: int) -> DataFrame:
    """Deal the members of each ``bucket`` to the units ``(kind, i, j)`` in which
    those of different components meet. The members of a bucket's largest
    component need not meet each other: their blocks ``i`` meet the others'
    blocks ``j`` (kind 0), whose pairs of blocks are units, too (kind 1)."""
    sizes = members.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    sizes = (sizes.groupBy("bucket").agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("all"))
             .select("bucket", F.col("top.component").alias("major"), F.ceil(F.col("top.n") / block).cast("int").alias("majors"),
                     F.ceil((F.col("all") - F.col("top.n")) / block).cast("int").alias("minors")))
    columns = [c for c in members.columns if c != "bucket"]
    dealt = members.join(sizes, "bucket").withColumn("is_major", F.col("component") == F.col("major"))
    own = F.pmod(F.xxhash64("node"), F.when(F.col("is_major"), F.col("majors")).otherwise(F.col("minors"))).cast("int")
    dealt = dealt.withColumn("own", own)

    def upto(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    major = dealt.where("is_major").withColumn("j", upto("minors")).select("bucket", F.lit(0).alias("kind"), F.col("own").alias("i"), "j", F.lit(True).alias("in_i"), *columns)
    minor = dealt.where("not is_major")
    facing = minor.withColumn("i", upto("majors")).select("bucket", F.lit(0).alias("kind"), "i", F.col("own").alias("j"), F.lit(False).alias("in_i"), *columns)
    among = minor.withColumn("other", upto("minors")).select(
        "bucket", F.lit(1).alias("kind"), F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        (F.col("own") <= F.col("other")).alias("in_i"), *columns)
    return major.unionByName(facing).unionByName(among)


def _blocks(members: DataFrame, group: str, block: int) -> DataFrame:
    """Give every class of a group to the block pairs ``(i, j)`` it takes part
    in: ``group, i, j`` and whether it is of block i, with its columns."""
    sizes = members.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts"))
    own = (members.join(sizes, group)
           .withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")))
    return (own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .select(group, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                    (F.col("own") <= F.col("other")).alias("in_i"), *[c for c in members.columns if c != group]))


def _units(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[list[pa.RecordBatch]]:
    """The rows of each key, from batches sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in names])
        bounds = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), batch.num_rows]
        for k, (lo, hi) in enumerate(zip(bounds, bounds[1:], strict=False)):
            if lo == hi:
                continue
            if held and (k > 0 or any(held[-1].column(c)[0] != batch.column(c)[lo] for c in names)):
                yield held
                held = []
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield held


def _verify_task(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in _units(batches, ("component", "i", "j")):
            yield _verify_unit(parts, threshold)
    return run


def _verify_unit(parts: list[pa.RecordBatch], threshold: float) -> pa.RecordBatch:
    """Links of one block pair: per class its linked classes and documents, and
    one class that it hangs together with."""
    table = pa.Table.from_batches(parts)
    n = table.num_rows
    node = table.column("node").to_numpy()
    copies = table.column("copies").to_numpy().astype(float)
    in_i = table.column("in_i").to_numpy(zero_copy_only=False).astype(bool)
    inner = table.column("i")[0].as_py() == table.column("j")[0].as_py()
    data, offsets = utf8(table.column("text").combine_chunks())
    hashes, rows, _ = document_shingles(data, offsets)
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    new = np.ones(len(rows), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    hashes, rows = hashes[new], rows[new]
    size = np.bincount(rows, minlength=n)
    _, term = np.unique(hashes, return_inverse=True)
    shared = np.bincount(term)[term] > 1
    terms, column = np.unique(term[shared], return_inverse=True)
    rows = rows[shared]
    common = np.zeros((n, n), np.float32)
    order = np.argsort(column, kind="stable")
    column, rows = column[order], rows[order]
    width = 8192
    for at in range(0, len(terms), width):
        lo, hi = np.searchsorted(column, [at, at + width])
        held = np.zeros((n, min(width, len(terms) - at)), np.float32)
        held[rows[lo:hi], column[lo:hi] - at] = 1
        common += held @ held.T
    union = size[:, None] + size[None, :] - common
    linked = common >= threshold * union - 1e-6
    np.fill_diagonal(linked, False)
    if not inner:  # pairs within a block belong to that block's own unit
        linked &= in_i[:, None] != in_i[None, :]
    root = node[_smallest_linked(linked)]
    some = linked.any(1)
    return pa.RecordBatch.from_arrays(
        [pa.array(node[some]), pa.array(root[some]), pa.array(linked.sum(1)[some].astype(np.int64)),
         pa.array((linked @ copies)[some].astype(np.int64))], ["node", "root", "texts", "documents"])


def ngram_links(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """Per document: ``id_col``, ``class_id`` (smallest id of the documents that
    links connect with it), ``n_links`` (other documents linked, copies
    included), ``n_similar_texts`` (other texts linked), ``copy_id`` (smallest id
    of the documents with the same words) and ``n_copies`` (their number, itself
    included)."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    classes = saved(
        rows.mapInArrow(_sketch_task, f"digest binary, id {id_type}, mins binary, sketch binary")
        .groupBy("digest").agg(F.min("id").alias("copy_id"), F.count(F.lit(1)).alias("copies"),
                               F.first("mins").alias("mins"), F.first("sketch").alias("sketch"))
        .withColumn("node", F.monotonically_increasing_id()), "ngram_join", "classes")
    members = candidate_components(classes, threshold, recall, block)
    # the text of one document of each class that may have links
    wanted = classes.join(members, "node").select("digest", "node", "component", "copies")
    texts = (rows.mapInArrow(_digest_task, f"digest binary, id {id_type}, text string").drop("id")
             .join(wanted, "digest").groupBy("node", "component", "copies").agg(F.min("text").alias("text")))
    units = (_blocks(texts, "component", block).repartition("component", "i", "j").sortWithinPartitions("component", "i", "j"))
    found = saved(units.mapInArrow(_verify_task(threshold), "node long, root long, texts long, documents long"), "ngram_join", "links")
    groups = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    sums = found.groupBy("node").agg(F.sum("texts").alias("texts"), F.sum("documents").alias("documents"))
    slim = classes.select("digest", "node", "copy_id", "copies")
    grouped = (slim.join(groups, "node", "left").join(sums, "node", "left")
               .withColumn("component", F.coalesce("component", "node")))
    smallest = grouped.groupBy("component").agg(F.min("copy_id").alias("class_id"))
    per_class = grouped.join(smallest, "component").select("digest", "copy_id", "class_id", "copies", "texts", "documents")
    ids = rows.mapInArrow(_digest_task, f"digest binary, id {id_type}, text string").select("digest", "id")
    return (ids.join(per_class, "digest", "left")
            .select(F.col("id").alias(id_col), F.coalesce("class_id", "id").alias("class_id"),
                    (F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("documents", F.lit(0))).cast("long").alias("n_links"),
                    F.coalesce("texts", F.lit(0)).cast("long").alias("n_similar_texts"),
                    F.coalesce("copy_id", "id").alias("copy_id"),
                    F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies")))
