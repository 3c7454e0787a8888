"""Conversation prefix trie on double arrays.

*Sequences.* A conversation is a sequence of turns, a turn the digest of its
role and text and the text's length in bytes; no step after the first carries
texts. Equal sequences are one row with a count, so a conversation copied a
thousand times is walked once.

*Shards.* Sequences that share a prefix of ``s`` turns share a shard. ``s`` is
the least depth at which no more than ``HOT`` different sequences (or one in
``MAX_HOT``, if that is more) share the prefix; it grows turn by turn, so a
first turn that a third of all conversations begin with is split by second
turns, and so on. Nodes above depth ``s`` are shared by shards, all others
belong to one.

*Double arrays.* A shard numbers its turns densely and packs its trie into BASE
and CHECK: the child of node ``p`` by turn ``t`` is cell ``BASE[p] + t``, if
``CHECK`` of that cell is ``p``. Nodes with several children take the first
place where all of them fit, the others the cells left free. The sequences are
then walked through the arrays, level by level, and counted in the cells.

*Merge.* Shards report their own nodes whole, and their part of the shared
ones: members, and the sums over those children that are the shard's own. The
parts are added up, and the sums passed on to all shared ancestors. There are
at most ``MAX_HOT`` shared nodes of a depth, so they may be broadcast to give
the topmost nodes of the shards their parents.

Defined results: turns are ordered by number (null first), ties by role, then by
the digest of the text; a null role or text is empty; rows without a
conversation id belong to none and are left out; a conversation may be without
turns; an empty table gives an empty result. Only the four named columns are
read. A conversation's digests (24 bytes a turn) have to fit into a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import saved

HOT = 512
MAX_HOT = 100_000
SHARD_ROWS = 2048
#: Members of a node are joined in blocks of ``2 ** BLOCK_BITS`` ids.
BLOCK_BITS = 10
#: Free cells looked through for a node with several children.
WINDOW = 2048
NO_ENDS = hashlib.sha256(b"").hexdigest()


# --- double array -------------------------------------------------------------

class DoubleArray:
    """BASE and CHECK over dense turn ids; cell 0 is the root."""

    def __init__(self) -> None:
        self.base = np.zeros(1024, np.int64)
        self.check = np.full(1024, -1, np.int64)
        self.check[0] = 0
        self.free_from = 1
        self.end = 1  # no cell from here on is taken

    def _room(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])

    def _take(self, cells: np.ndarray, parents) -> None:
        self.check[cells] = parents
        self.end = max(self.end, int(cells.max()) + 1)

    def add_level(self, parent: np.ndarray, turn: np.ndarray) -> None:
        """All children of one level: distinct ``(parent, turn)`` pairs, sorted."""
        if not len(parent):
            return
        head = np.flatnonzero(np.append(True, parent[1:] != parent[:-1]))
        size = np.diff(np.append(head, len(parent)))
        several = np.flatnonzero(size > 1)
        for k in several[np.argsort(-size[several], kind="stable")].tolist():
            turns = turn[head[k]:head[k] + size[k]]
            base = self._fit(turns)
            self.base[parent[head[k]]] = base
            self._take(base + turns, parent[head[k]])
        one = head[size == 1]
        if len(one):
            self._room(self.end + len(one))
            cells = self.free_from + np.flatnonzero(self.check[self.free_from:self.end + len(one)] < 0)[:len(one)]
            self.base[parent[one]] = cells - turn[one]
            self._take(cells, parent[one])
            self.free_from = int(cells[-1]) + 1

    def _fit(self, turns: np.ndarray) -> int:
        """The first base, of those looked at, whose cells are all free."""
        self._room(self.end + int(turns[-1] - turns[0]) + 1)
        free = self.free_from + np.flatnonzero(self.check[self.free_from:min(self.free_from + WINDOW, self.end)] < 0)
        base = free - turns[0]
        for t in turns[1:]:
            base = base[(base + t >= self.end) | (self.check[np.minimum(base + t, self.end)] < 0)]
        return int(base[0] if len(base) else self.end - turns[0])

    def child(self, cell: np.ndarray, turn: np.ndarray) -> np.ndarray:
        """Cells of the children, -1 where there is none."""
        at = self.base[cell] + turn
        inside = (at > 0) & (at < len(self.check))
        return np.where(inside & (self.check[np.where(inside, at, 0)] == cell), at, -1)


def pack(turns: np.ndarray, start: np.ndarray, size: np.ndarray) -> DoubleArray:
    """The trie of the sequences ``turns[start:start + size]``."""
    trie = DoubleArray()
    cell = np.zeros(len(size), np.int64)
    for depth in range(int(size.max(initial=0))):
        on = np.flatnonzero(size > depth)
        pairs = np.unique(np.column_stack([cell[on], turns[start[on] + depth]]), axis=0)
        trie.add_level(pairs[:, 0], pairs[:, 1])
        cell[on] = trie.child(cell[on], turns[start[on] + depth])
    return trie


# --- one shard ----------------------------------------------------------------

NODE_TYPE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
             "ends_sha256 string, shared boolean, bytes long, path array<binary>")
_NODE = pa.schema([*((c, pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")),
                   ("ends_sha256", pa.string()), ("shared", pa.bool_()), ("bytes", pa.int64()), ("path", pa.list_(pa.binary()))])


def prefix_key(turns: list[bytes]) -> bytes:
    return hashlib.md5(b"".join(turns)).digest()


def shard_nodes(shard: pa.Table) -> pa.Table:
    """The nodes of a shard. ``path``: keys of the shared nodes on the way (of a
    node's own, if it is shared); of a shared node ``n_children``, ``n_leaves``
    and ``saved_tokens`` tell of the shard's own children only."""
    shard = shard.combine_chunks()
    lists = shard.column("turns").combine_chunks()
    digests = lists.flatten()
    size = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    start = np.cumsum(size) - size
    coded = digests.dictionary_encode() if len(digests) else None
    turn = coded.indices.to_numpy().astype(np.int64) if coded is not None else np.zeros(0, np.int64)
    names = coded.dictionary.to_pylist() if coded is not None else []
    n_bytes = shard.column("bytes").combine_chunks().flatten().to_numpy().astype(np.int64)
    settled, weight, conv = (shard.column(c).to_numpy() for c in ("settled", "n", "conv_id"))
    ends = shard.column("ends_sha256").to_pylist()

    trie = pack(turn, start, size)
    cells = len(trie.check)
    count, least = np.zeros(cells, np.int64), np.full(cells, np.iinfo(np.int64).max)
    depth_of, byte_of, by, ends_of = np.full(cells, -1), np.zeros(cells, np.int64), np.zeros(cells, np.int64), {}
    shared = np.zeros(cells, bool)
    levels = []
    cell, on = np.zeros(len(size), np.int64), np.arange(len(size))
    for depth in range(int(size.max(initial=0)) + 1):
        if depth:
            on = on[size[on] >= depth]
            cell[on] = trie.child(cell[on], turn[start[on] + depth - 1])
            byte_of[cell[on]] = n_bytes[start[on] + depth - 1]
        at = cell[on]
        np.add.at(count, at, weight[on])
        np.minimum.at(least, at, conv[on])
        depth_of[at], by[at] = depth, on
        shared[at] = depth < settled[on]
        ends_of.update(zip(at[size[on] == depth].tolist(), (ends[i] for i in on[size[on] == depth].tolist()), strict=True))
        levels.append(np.unique(at))

    children, leaves, kept = np.zeros(cells, np.int64), np.zeros(cells, np.int64), np.zeros(cells, np.int64)
    for nodes in reversed(levels):
        own = nodes[~shared[nodes]]
        leaves[own] += children[own] == 0
        kept[own] += (count[own] - 1) * byte_of[own]
        parent = trie.check[own]
        np.add.at(children, parent, 1)
        np.add.at(leaves, parent, leaves[own])
        np.add.at(kept, parent, kept[own])

    nodes = np.concatenate(levels)
    top = nodes[shared[nodes]]
    paths: dict[int, list[bytes]] = {}
    for c in top.tolist():  # parents come first
        before = [names[turn[start[by[c]] + k]] for k in range(depth_of[c])]
        paths[c] = [*paths.get(int(trie.check[c]), [])[:depth_of[c]], prefix_key(before)] if c else [prefix_key([])]
    parent = trie.check[nodes]
    above = shared[parent] | shared[nodes]
    return pa.Table.from_arrays(
        [pa.array(least[nodes]), pa.array(depth_of[nodes].astype(np.int64)), pa.array(least[parent], mask=above), pa.array(count[nodes]), pa.array(children[nodes]),
         pa.array(leaves[nodes]), pa.array(kept[nodes]), pa.array([ends_of.get(c) for c in nodes.tolist()], pa.string()), pa.array(shared[nodes]),
         pa.array(byte_of[nodes]), pa.array([paths[c] if s else paths[p] if a else None for c, p, s, a in
                                             zip(nodes.tolist(), parent.tolist(), shared[nodes].tolist(), above.tolist(), strict=True)], pa.list_(pa.binary()))],
        schema=_NODE)


# --- Spark steps --------------------------------------------------------------

def conversation_turns(rows: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                       text_col: str = "text") -> DataFrame:
    """``conv_id, turns, bytes``: per conversation the ordered digests and text lengths."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    one = F.struct(F.col(f"`{turn_col}`").alias("turn"), role.alias("role"), F.md5(text).alias("text"), digest.alias("digest"),
                   F.octet_length(text).cast("long").alias("bytes"))
    listed = (rows.where(F.col(f"`{conv_col}`").isNotNull()).select(F.col(f"`{conv_col}`").cast("long").alias("conv_id"), one.alias("t"))
              .groupBy("conv_id").agg(F.array_sort(F.collect_list("t"), _by_turn).alias("t")))
    return listed.select("conv_id", F.col("t.digest").alias("turns"), F.col("t.bytes").alias("bytes"))


def _by_turn(x: Column, y: Column) -> Column:
    """Comparator: turn number, null first; then role, then digest of the text."""
    def order(a: Column, b: Column, after: Column) -> Column:
        return F.when(a < b, F.lit(-1)).when(a > b, F.lit(1)).otherwise(after)

    rest = order(x["role"], y["role"], order(x["text"], y["text"], F.lit(0)))
    return (F.when(x["turn"].isNull() & y["turn"].isNull(), rest).when(x["turn"].isNull(), F.lit(-1)).when(y["turn"].isNull(), F.lit(1))
            .otherwise(order(x["turn"], y["turn"], rest)))


def _ends_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the blocks of each sequence (rows come sorted)."""
    key, hashed = None, None
    for batch in batches:
        keys, sums = [], []
        for k, ids in zip(batch.column("seq").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if k == key:
                hashed.update(b"," + ids.encode())
                continue
            if key is not None:
                keys.append(key)
                sums.append(hashed.hexdigest())
            key, hashed = k, hashlib.sha256(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sums, pa.string())], ["seq", "ends_sha256"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([hashed.hexdigest()])], ["seq", "ends_sha256"])


def _key(turns: Column) -> Column:
    """Digest of a list of digests."""
    return F.unhex(F.md5(F.aggregate(turns, F.lit(b""), lambda a, t: F.concat(a, t))))


def sequences(conversations: DataFrame) -> DataFrame:
    """``turns, bytes, n, conv_id, ends_sha256``: the different sequences, with
    the number of their conversations, the smallest id, and the digest of all
    ids, ascending. Ids are gathered by blocks of neighbouring ids, so no group
    of copies is held by a task."""
    keyed = saved(conversations.withColumn("seq", _key(F.col("turns"))), "prefix_trie", "conversations")
    one = keyed.groupBy("seq").agg(F.first("turns").alias("turns"), F.first("bytes").alias("bytes"), F.count(F.lit(1)).alias("n"),
                                   F.min("conv_id").alias("conv_id"))
    blocks = (keyed.groupBy("seq", F.shiftright("conv_id", BLOCK_BITS).alias("block"))
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")))
    ends = (blocks.repartition("seq").sortWithinPartitions("seq", "block").select("seq", "ids")
            .mapInArrow(_ends_task, "seq binary, ends_sha256 string"))
    return one.join(ends, "seq").drop("seq")


def _settled(seqs: DataFrame, hot: int) -> DataFrame:
    """``settled``: the depth from which on a sequence's nodes are its shard's own."""
    out, depth = seqs.withColumn("settled", F.lit(1)), 1
    while True:
        key = F.when((F.col("settled") == depth) & (F.size("turns") >= depth), _key(F.slice("turns", 1, depth)))
        common = saved(out.select(key.alias("key")).where(F.col("key").isNotNull()).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
                       .where(F.col("n") > hot).select(F.col("key").alias("hot_key")), "prefix_trie", "hot")
        if not common.limit(1).count():
            return out
        depth += 1
        out = (out.join(F.broadcast(common), key == F.col("hot_key"), "left")  # at most MAX_HOT rows
               .withColumn("settled", F.when(F.col("hot_key").isNotNull(), F.lit(depth)).otherwise(F.col("settled"))).drop("hot_key"))


def trie_nodes(conversations: DataFrame, *, hot: int = HOT, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256`` of every node of the trie of ``conversations``
    (``conv_id, turns, bytes``)."""
    spark = conversations.sparkSession
    seqs = saved(sequences(conversations), "prefix_trie", "sequences")
    n = seqs.count()
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n // shard_rows + 1)
    dealt = _settled(seqs, max(hot, n // MAX_HOT)).withColumn(
        "shard", F.pmod(F.xxhash64(_key(F.slice("turns", 1, F.least("settled", F.size("turns"))))), F.lit(shards)))
    nodes = saved(dealt.groupBy("shard").applyInArrow(shard_nodes, NODE_TYPE), "prefix_trie", "nodes")
    top = saved(_merged(nodes.where("shared")), "prefix_trie", "shared")
    convs = top.select(F.col("key").alias("above"), F.col("conv_id").alias("above_conv"))
    own = (nodes.where(~F.col("shared")).withColumn("above", F.element_at("path", -1))
           .join(F.broadcast(convs), "above", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above_conv")))
    both = [*("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"),
            F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256")]
    return own.select(*both).unionByName(top.select(*both))


def _merged(parts: DataFrame) -> DataFrame:
    """Shared nodes from the shards' parts of them."""
    top = parts.groupBy("path").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("below"), F.max("ends_sha256").alias("ends_sha256"), F.max("bytes").alias("bytes"))
    top = saved(top.withColumn("key", F.element_at("path", -1)).withColumn("parent", F.get("path", F.size("path") - 2)), "prefix_trie", "merged")
    # a shared node has many sequences and so children: it is no leaf itself
    saved_here = F.col("below") + F.when(F.col("depth") > 0, (F.col("n_convs") - 1) * F.col("bytes")).otherwise(F.lit(0))
    sums = (top.select(F.explode("path").alias("key"), F.col("n_leaves").alias("l"), saved_here.alias("s"))
            .groupBy("key").agg(F.sum("l").alias("all_leaves"), F.sum("s").alias("all_saved")))
    children = top.where("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("shared_children"))
    parents = top.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    joined = top.drop("n_leaves").join(sums, "key").join(children, "key", "left").join(parents, "parent", "left")
    total = F.col("n_children") + F.coalesce("shared_children", F.lit(0))
    # the root of turnless conversations alone is the one childless shared node
    return joined.select("key", "conv_id", "depth", "parent_conv_id", "n_convs", total.alias("n_children"),
                         F.when(total == 0, F.lit(1)).otherwise(F.col("all_leaves")).cast("long").alias("n_leaves"),
                         F.col("all_saved").alias("saved_tokens"), "ends_sha256")
