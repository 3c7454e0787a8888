"""SentencePiece encoding and decoding over a piece table.

Encoding follows the relational lattice, over the distinct words of each slice
of a task's documents, as columns. The ids of words met before are remembered
(``_Words``), so only those new to a task go through it:

1. *Explode*: every substring of a word, up to the longest piece, one row each
   (a start is dropped once its substring begins no piece).
2. *Equi-join* with the piece table on the substring's 64-bit hash: the edges.
3. *Group* the edges by word and end position.
4. *Fold* from left to right, Viterbi style, all words at once: every position
   keeps the one piece that ends the best path to it, then the paths are read
   back.

The transition of the fold is the model's own. A byte-pair model merges the
best-scored neighbours first, which a sum of scores does not reproduce; but a
sequence of pieces is its encoding exactly if merging would leave every two
neighbouring pieces apart. So a piece may follow the piece kept at its start
only if the pair is *stable* in that sense, and exactly one edge per position
is. Stability is worked out from the merge order (``_Pairs``) and remembered.
The ids are those of the ``sentencepiece`` library for the same model file.

A word is a run of spaces with the text up to the next space. Characters that
stand in no piece end words and become byte pieces. Words that begin with
several spaces, whose pieces share one score, are merged one by one in the
library's order (``_merge``).

Defined results: null gives null ids, an empty text no ids; very long words
take one fold step per character; an id outside the table is an error when
decoding, null decodes to null. U+2581 is the model's space and decodes to a
space. Repeated rows give repeated rows, an empty table an empty result. Extra
columns are kept, one named like the result column is replaced.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .textarrays import SpanHash, mix, slices, utf8

SPACE = 0x2581
_BITS = 22  # bitmaps over hash prefixes: half a megabyte each
_CACHE = 1 << 21
#: Text bytes encoded at once: the lattice takes some 150 bytes of memory for each.
ENCODE_BYTES = 500_000
#: Words, and ids of words, that a task remembers before it forgets the rare ones.
KEPT_WORDS, KEPT_IDS = 1 << 19, 1 << 22


class PieceTable:
    """Pieces of a byte-pair SentencePiece model file, in plain values."""

    def __init__(self, model: bytes):
        m = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = m.vocab_size()
        self.pieces = [m.id_to_piece(i) for i in range(size)]
        self.normal = [i for i in range(size) if not (m.is_unknown(i) or m.is_control(i) or m.is_byte(i) or m.is_unused(i))]
        self.rank = np.zeros(size)
        for i in self.normal:
            self.rank[i] = -m.get_score(i)
        self.byte_id = np.full(256, -1, np.int64)
        for i in range(size):
            if m.is_byte(i):
                self.byte_id[int(self.pieces[i][3:-1], 16)] = i
        self.id_of = {self.pieces[i]: i for i in self.normal}
        space = chr(SPACE)
        inner = [p for p in self.id_of if space in p.lstrip(space)]
        missing = {c for p in self.id_of for c in p} - set(self.id_of)
        if inner or missing or (self.byte_id < 0).any():
            raise ValueError("the piece table must have byte pieces, every character of a piece as a piece, "
                             "and spaces only at the beginning of pieces")
        if m.encode("a  a", out_type=str)[0][:1] != space or m.decode(m.encode(" a  a ")) != " a  a ":
            raise ValueError("the model must put a space before a text and keep all others")


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)


def _values(points: np.ndarray) -> np.ndarray:
    return mix(points.astype(np.uint64) + np.uint64(0xC2B2AE3D))


def _hash(points: np.ndarray) -> SpanHash:
    return SpanHash.of(_values(points))


class _Pairs:
    """Which two pieces stay apart when their joined text is merged.

    The merges inside the left piece build it from its right end's point of
    view along right parts, those inside the right piece along left parts. Going
    back in time from both whole pieces, the one whose last merge is the later
    is undone; at every moment the two symbols that face each other must not
    form a piece that would have been merged before the next merge of either.
    At equal scores the merge further left comes first.
    """

    def __init__(self, table: PieceTable):
        n = self.size = len(table.pieces)
        self.rank = table.rank
        keys, merged = [], []
        for i in table.normal:
            p = table.pieces[i]
            for k in range(1, len(p)):
                a, b = table.id_of.get(p[:k]), table.id_of.get(p[k:])
                if a is not None and b is not None:
                    keys.append(a * n + b)
                    merged.append(i)
        order = np.argsort(keys)
        self.keys, self.merged = np.array(keys, np.int64)[order], np.array(merged, np.int64)[order]
        self.left, self.right = np.full(n, -1), np.full(n, -1)
        for i in table.normal:
            if len(table.pieces[i]) > 1:
                parts = _merge(table.pieces[i], table, last=table.rank[i])
                if len(parts) == 2:
                    self.left[i], self.right[i] = parts
        self.cache_key = np.full(_CACHE, -1, np.int64)
        self.cache_value = np.zeros(_CACHE, bool)

    def stable(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.size + b
        slot = (mix(key.astype(np.uint64)) >> np.uint64(64 - 21)).astype(np.int64)
        out = self.cache_value[slot]
        new = np.flatnonzero(self.cache_key[slot] != key)
        if len(new):
            fresh, inverse = np.unique(key[new], return_inverse=True)
            value = self._work_out(fresh // self.size, fresh % self.size)
            out[new] = value[inverse]
            self.cache_key[slot[new]] = key[new]
            self.cache_value[slot[new]] = out[new]
        return out

    def _work_out(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        good = np.ones(len(a), bool)
        live = np.arange(len(a))
        x, y = a.copy(), b.copy()
        before_left = np.full(len(a), np.inf)  # ranks of the next merges of x and of y
        before_right = np.full(len(a), np.inf)
        while len(live):
            key = x * self.size + y
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where(self.keys[at] == key, self.rank[self.merged[at]], np.inf)
            # a tie with the merge on the left is lost, one with that on the right is won
            joins = (rank < before_left) & (rank <= before_right) & (rank < np.inf)
            good[live[joins]] = False
            can_x, can_y = self.right[x] >= 0, self.left[y] >= 0
            undo_x = can_x & (~can_y | (self.rank[x] > self.rank[y]))
            undo_y = can_y & ~undo_x
            before_left = np.where(undo_x, self.rank[x], before_left)
            before_right = np.where(undo_y, self.rank[y], before_right)
            x, y = np.where(undo_x, self.right[x], x), np.where(undo_y, self.left[y], y)
            on = ~joins & (undo_x | undo_y)
            live, x, y, before_left, before_right = live[on], x[on], y[on], before_left[on], before_right[on]
        return good


def _merge(word: str, table: PieceTable, last: float = np.inf) -> list[int]:
    """Pieces of one word by merging the best-scored neighbours, leftmost
    first; merges that score no better than ``last`` are left out."""
    symbol: list[int | None] = [table.id_of[c] for c in word]
    before, after = list(range(-1, len(word) - 1)), list(range(1, len(word) + 1))
    queue: list[tuple[float, int, int, int, int]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < len(word):
            joined = table.id_of.get(table.pieces[symbol[i]] + table.pieces[symbol[j]])
            if joined is not None and table.rank[joined] < last:
                heapq.heappush(queue, (table.rank[joined], i, joined, symbol[i], symbol[j]))

    for i in range(len(word) - 1):
        offer(i)
    while queue:
        _, i, joined, a, b = heapq.heappop(queue)
        j = after[i]
        if symbol[i] != a or j >= len(word) or symbol[j] != b:
            continue
        symbol[i], symbol[j] = joined, None
        after[i] = after[j]
        if after[j] < len(word):
            before[after[j]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [s for s in symbol if s is not None]


class _Words:
    """Ids of words that were encoded, by the words' hashes (in order)."""

    def __init__(self):
        self.hashes, self.again = np.zeros(0, np.uint64), np.zeros(0, bool)  # again: met in a later slice too
        self.first, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids, self.used = np.zeros(1 << 16, np.int32), 0

    def make_room(self) -> None:
        """Once there are too many words, forget those not met again; all, if
        that leaves too many."""
        if len(self.hashes) <= KEPT_WORDS and self.used <= KEPT_IDS:
            return
        old, kept = (self.hashes, self.first, self.count, self.ids), np.flatnonzero(self.again)
        self.__init__()
        hashes, first, count = (x[kept] for x in old[:3])
        offsets = np.concatenate([[0], np.cumsum(count)])
        if len(kept) <= KEPT_WORDS // 2 and offsets[-1] <= KEPT_IDS // 2:
            self.add(hashes, old[3][np.repeat(first - offsets[:-1], count) + np.arange(offsets[-1])], offsets)

    def missing(self, hashes: np.ndarray) -> np.ndarray:
        """Places of the ``hashes`` that are not here."""
        if not len(self.hashes):
            return np.arange(len(hashes))
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        here = self.hashes[at] == hashes
        self.again[at[here]] = True
        return np.flatnonzero(~here)

    def add(self, hashes: np.ndarray, ids: np.ndarray, offsets: np.ndarray) -> None:
        """Words that are not here yet, in order of their hashes."""
        end = self.used + len(ids)
        if end > len(self.ids):
            grown = np.zeros(2 * end, np.int32)
            grown[:self.used] = self.ids[:self.used]
            self.ids = grown
        self.ids[self.used:end] = ids
        at = np.searchsorted(self.hashes, hashes)
        self.first = np.insert(self.first, at, self.used + offsets[:-1])
        self.count = np.insert(self.count, at, np.diff(offsets))
        self.again = np.insert(self.again, at, False)
        self.hashes = np.insert(self.hashes, at, hashes)
        self.used = end

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in ``ids`` the words' ids begin, and how many they are."""
        at = np.searchsorted(self.hashes, hashes)
        return self.first[at], self.count[at]


class Encoder:
    def __init__(self, table: PieceTable):
        self.table = table
        self.words = _Words()
        self.pairs = _Pairs(table)
        self.known = np.zeros(0x110000, bool)
        lengths = np.array([len(table.pieces[i]) for i in table.normal])
        points = _code_points("".join(table.pieces[i] for i in table.normal))
        self.known[points] = True
        ends = np.cumsum(lengths)
        span = _hash(points)
        h = span(ends - lengths, ends)
        order = np.argsort(h)
        self.hashes, self.ids = h[order], np.array(table.normal)[order]
        self.length = np.zeros(len(table.pieces), np.int64)
        self.length[table.normal] = lengths
        self.longest = int(lengths.max())
        self.is_piece, self.is_prefix = (np.zeros(1 << _BITS, bool) for _ in range(2))
        self.is_piece[h >> np.uint64(64 - _BITS)] = True
        for k in range(1, self.longest + 1):
            long = np.flatnonzero(lengths >= k)
            self.is_prefix[span(ends[long] - lengths[long], ends[long] - lengths[long] + k) >> np.uint64(64 - _BITS)] = True

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows of UTF-8 texts, and the row offsets into them."""
        rows = len(offsets) - 1
        raw = _code_points(data.tobytes().decode("utf-8", "surrogatepass"))
        leads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        begin = leads[offsets]
        some = np.diff(begin) > 0
        # one space before every text that is not empty
        points = np.insert(raw, begin[:-1][some], 32)
        bounds = begin + np.concatenate([[0], np.cumsum(some)])
        points[points == 32] = SPACE
        if not len(points):
            return np.zeros(0, np.int32), np.zeros(rows + 1, np.int64)
        space, strange = points == SPACE, ~self.known[points]
        first = strange | np.append(False, strange[:-1]) | (space & ~np.append(False, space[:-1]))
        first[bounds[:-1][some]] = True
        start = np.flatnonzero(first)
        end = np.append(start[1:], len(points))
        span = _hash(points)
        distinct, chosen, which = np.unique(span(start, end), return_index=True, return_inverse=True)
        self.words.make_room()
        new = self.words.missing(distinct)
        if len(new):
            self.words.add(distinct[new], *self._encode_words(points, span, start[chosen[new]], end[chosen[new]], strange))
        first, count = (x[which] for x in self.words.places(distinct))
        total = np.concatenate([[0], np.cumsum(count)])
        out = self.words.ids[np.repeat(first - total[:-1], count) + np.arange(total[-1])]
        return out, total[np.searchsorted(start, bounds)]

    def _encode_words(self, points, span, start, end, strange):
        """Ids and offsets of distinct words given as spans of ``points``."""
        several = points[np.minimum(start + 1, len(points) - 1)] == SPACE
        single = np.flatnonzero((end - start == 1) & strange[start])
        special: dict[int, list[int]] = {}
        for w in single.tolist():
            special[w] = self.table.byte_id[list(chr(points[start[w]]).encode("utf-8", "surrogatepass"))].tolist()
        for w in np.flatnonzero(several & (end - start > 1) & (points[start] == SPACE)).tolist():
            special[w] = _merge("".join(map(chr, points[start[w]:end[w]].tolist())), self.table)
        plain = np.ones(len(start), bool)
        plain[list(special)] = False
        plain = np.flatnonzero(plain)
        ids, count = self._fold(span, start[plain], end[plain])
        n = np.zeros(len(start), np.int64)
        n[plain] = count
        for w, pieces in special.items():
            n[w] = len(pieces)
        offsets = np.concatenate([[0], np.cumsum(n)])
        out = np.zeros(offsets[-1], np.int64)
        base = np.concatenate([[0], np.cumsum(count)])[:-1]
        out[np.repeat(offsets[plain] - base, count) + np.arange(len(ids))] = ids
        for w, pieces in special.items():
            out[offsets[w]:offsets[w + 1]] = pieces
        return out, offsets

    def _edges(self, span, start, end):
        """``(word, end position, length, piece)`` of every piece in every word."""
        size = end - start
        word = np.repeat(np.arange(len(start)), size)
        at = np.arange(size.sum()) - np.repeat(np.concatenate([[0], np.cumsum(size)])[:-1], size)
        found = []
        for k in range(1, self.longest + 1):
            inside = at + k <= size[word]
            word, at = word[inside], at[inside]
            if not len(word):
                break
            h = span(start[word] + at, start[word] + at + k)
            top = h >> np.uint64(64 - _BITS)
            maybe = np.flatnonzero(self.is_piece[top])
            place = np.minimum(np.searchsorted(self.hashes, h[maybe]), len(self.hashes) - 1)
            hit = self.hashes[place] == h[maybe]
            e = maybe[hit]
            found.append((word[e], at[e] + k, np.full(len(e), k), self.ids[place[hit]]))
            on = self.is_prefix[top]
            word, at = word[on], at[on]
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def _fold(self, span, start, end) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain words, concatenated, and their number per word."""
        if not len(start):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        word, stop, length, piece = self._edges(span, start, end)
        size = end - start
        base = np.concatenate([[0], np.cumsum(size + 1)])[:-1]
        last = np.full(int((size + 1).sum()), -1, np.int64)  # piece that ends the path to a position
        order = np.argsort(stop, kind="stable")
        word, stop, length, piece = word[order], stop[order], length[order], piece[order]
        cuts = np.searchsorted(stop, np.arange(1, int(size.max()) + 2))
        for j, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False), 1):
            w, k, p = word[lo:hi], length[lo:hi], piece[lo:hi]
            previous = last[base[w] + j - k]
            fits = k == j
            later = np.flatnonzero(~fits & (previous >= 0))
            fits[later] = self.pairs.stable(previous[later], p[later])
            last[base[w[fits]] + j] = p[fits]
        # read the paths back, all words in step
        at, live, parts = size.copy(), np.arange(len(size)), []
        while len(live):
            p = last[base[live] + at[live]]
            parts.append((live, p))
            at[live] -= self.length[p]
            live = live[at[live] > 0]
        owner = np.concatenate([x for x, _ in parts])
        pieces = np.concatenate([x for _, x in parts])
        order = np.argsort(owner, kind="stable")
        owner, pieces = owner[order], pieces[order]
        count = np.bincount(owner, minlength=len(size))
        first = np.concatenate([[0], np.cumsum(count)])
        mirror = first[owner] + first[owner + 1] - 1 - np.arange(len(owner))
        return pieces[mirror], count


class Decoder:
    def __init__(self, table: PieceTable):
        size = len(table.pieces)
        texts = [b""] * size
        for i in table.normal:
            texts[i] = table.pieces[i].replace(chr(SPACE), " ").encode()
        for b, i in enumerate(table.byte_id.tolist()):
            texts[i] = bytes([b])
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.size = size

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        if len(ids) and (ids.min() < 0 or ids.max() >= self.size):
            raise ValueError("an id is not in the piece table")
        n = (self.offsets[1:] - self.offsets[:-1])[ids]
        total = np.concatenate([[0], np.cumsum(n)])
        raw = self.data[np.repeat(self.offsets[ids] - total[:-1], n) + np.arange(total[-1])].tobytes()
        bounds = total[offsets].tolist()
        out = []
        for lo, hi in zip(bounds, bounds[1:], strict=False):
            text = raw[lo:hi].decode("utf-8", "replace")
            out.append(text[1:] if text.startswith(" ") else text)
        return out


_ready: dict[int, tuple] = {}


def _codec(model: bytes):
    """Encoder and decoder of a model, built once per Python worker."""
    key = hash(model)
    if key not in _ready:
        table = PieceTable(model)
        _ready[key] = (Encoder(table), Decoder(table))
    return _ready[key]


def _with_column(df: DataFrame, name: str, kind: T.DataType) -> tuple[DataFrame, T.StructType]:
    kept = df.select(*[F.col(f"`{c}`") for c in df.columns if c != name])
    return kept, T.StructType([*kept.schema.fields, T.StructField(name, kind)])


def read_model(path: str) -> bytes:
    """A model file (about half a megabyte), read where the driver can see it;
    the tasks get its bytes."""
    with open(path, "rb") as f:
        return f.read()


def encode_pieces(df: DataFrame, model: bytes, *, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``df`` with the piece ids of ``text_col``. Narrow: no shuffle."""
    kept, schema = _with_column(df, ids_col, T.ArrayType(T.IntegerType()))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, _ = _codec(model)
        try:
            for batch in batches:
                for part in slices(batch, text_col, ENCODE_BYTES):
                    column = part.column(text_col)
                    ids, offsets = encoder.encode(*utf8(column))
                    null = np.append(column.is_null().to_numpy(zero_copy_only=False), False)
                    made = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32), mask=null), pa.array(ids))
                    yield pa.RecordBatch.from_arrays([*part.columns, made], [*part.schema.names, ids_col])
        finally:  # the worker lives on, and other stages need the memory
            encoder.words = _Words()

    return kept.mapInArrow(task, schema)


def decode_pieces(df: DataFrame, model: bytes, *, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``df`` with the text of the piece ids. Narrow: no shuffle."""
    kept, schema = _with_column(df, text_col, T.StringType())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, decoder = _codec(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                column = part.column(ids_col)
                lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                ids = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)  # skips null lists
                text = decoder.decode(ids, np.concatenate([[0], np.cumsum(lengths)]))
                null = column.is_null().to_pylist()
                made = pa.array([None if gone else t for gone, t in zip(null, text, strict=True)], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, made], [*part.schema.names, text_col])

    return kept.mapInArrow(task, schema)
