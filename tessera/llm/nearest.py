"""Approximate nearest neighbours by cross-polytope hashing.

``TABLES`` fast pseudo-rotations (three rounds of random signs and a
Walsh-Hadamard transform) each send a unit vector to its nearest signed axis,
the bucket of that table. A query also probes its ``PROBES`` nearest axes of
each table. Candidates met in a bucket are ranked by their exact inner product
in double precision; the best of every query are merged over the buckets.

Nearness is the largest inner product. Candidates are told apart by length, in
bands of at most ``BAND_RATIO`` between the shortest and the longest. If lengths
in a band differ, its candidates get one more coordinate that makes them equal
(and queries a zero there), so the nearest axis follows the inner product. Every
band has its own buckets, and a query probes all bands. A band of up to about
``WHOLE_ROWS`` different vectors is not hashed: every query is compared with all
of it. So is a query with all vectors if the buckets give it no more than
``k`` different ones (its own among them): it gets its exact neighbours.

Equal vectors form one class with its ``k + 1`` smallest ids, which is all that
a result of ``k`` can need of them: a vector copied many times is hashed and
compared once. Within a bucket candidates are streamed past the queries in
blocks, and buckets above ``BUCKET_ROWS`` candidates are salted over several
tasks, so neither memory nor one task grows with a hot bucket. Every vector is
indexed.

Vectors that are null, zero, or hold null or non-finite components take no
part, neither do vectors of another dimension than the commonest (ties: the
smaller dimension). Rows with a null id take no part. Rows that repeat an id
are rows of their own; a query's own row is left out once. A table without
valid vectors gives an empty result. Only the id and vector columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir
from .hotkeys import join_counted

K = 20
TABLES = 16
PROBES = 8
BAND_RATIO = 1.1
WHOLE_ROWS = 512
BUCKET_ROWS = 4096
QUERY_ROWS = 16384
BLOCK_ROWS = 1024
PAIR_ROWS = 65536
_SEED = 977
#: The bucket of all bands that are compared whole.
_WHOLE = -1


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Binary vectors as rows of doubles."""
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), dim)


def _valid_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, ids, dims, lengths = [], [], [], []
        for i, v in zip(batch.column("id").to_pylist(), batch.column("vec"), strict=True):
            if i is None or not v.is_valid or v.values.null_count or not len(v.values):
                continue
            x = v.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
            if np.isfinite(x).all() and x.any():
                ids.append(i)
                rows.append(x.tobytes())
                dims.append(len(x))
                lengths.append(float(np.sqrt(np.dot(x, x))))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(rows, pa.binary()), pa.array(dims, pa.int32()),
                                          pa.array(lengths, pa.float64())], ["id", "vec", "dim", "length"])


def rotate(x: np.ndarray, table: int) -> np.ndarray:
    """Pseudo-rotation ``table`` of the rows of ``x``, padded to a power of two."""
    size = 1 << max(1, (x.shape[1] - 1).bit_length())
    signs = np.random.default_rng([_SEED, table]).choice([-1.0, 1.0], (3, size))
    y = np.zeros((len(x), size))
    y[:, :x.shape[1]] = x
    for s in signs:
        y = y * s
        h = 1
        while h < size:
            y = y.reshape(len(x), -1, 2, h)
            y = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(len(x), size)
            h *= 2
    return y


def _axes(x: np.ndarray, table: int, probes: int) -> np.ndarray:
    """The ``probes`` nearest signed axes of every row, nearest first."""
    y = rotate(x, table)
    order = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :probes]
    return 2 * order + (np.take_along_axis(y, order, 1) > 0)


def _lifted(x: np.ndarray, longest: float, query: bool) -> np.ndarray:
    rest = np.zeros(len(x)) if query else np.sqrt(np.maximum(longest**2 - (x * x).sum(1), 0))
    return np.column_stack([x, rest])


def _bucket_task(dim: int, tables: int, probes: int, bands: dict[int, float | None], query: bool):
    """``bands``: the hashed ones, each with the length its candidates are lifted to, or none."""
    width = 4 * (dim + 1)  # more than the number of signed axes
    base = {band: n * tables * width for n, band in enumerate(bands)}

    def hashed(x: np.ndarray) -> np.ndarray:
        return np.concatenate([t * width + _axes(x, t, probes) for t in range(tables)], axis=1)

    def buckets(part: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        x = _matrix(part.column("vec"), dim)
        every = np.arange(len(x))
        if query:
            yield every, np.full((len(x), 1), _WHOLE)
            # a query's axes are those of all bands that are lifted, whatever the length
            axes = {lifted: hashed(_lifted(x, 0.0, True) if lifted else x) for lifted in {v is not None for v in bands.values()}}
            for band, longest in bands.items():
                yield every, base[band] + axes[longest is not None]
            return
        mine = part.column("band").to_numpy()
        for band in np.unique(mine).tolist():
            at = np.flatnonzero(mine == band)
            if band not in bands:
                yield at, np.full((len(at), 1), _WHOLE)
            else:
                longest = bands[band]
                yield at, base[band] + hashed(x[at] if longest is None else _lifted(x[at], longest, False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                for at, found in buckets(part):
                    again = pa.array(np.repeat(at, found.shape[1]))
                    yield pa.RecordBatch.from_arrays([pa.array(found.ravel().astype(np.int64)), part.column("id").take(again),
                                                      part.column("vec").take(again)], ["bucket", "id", "vec"])
    return run


class _Best:
    """The best ``keep`` candidates of each query so far: score, then smaller id."""

    def __init__(self, keep: int):
        self.keep, self.parts, self.rows = keep, [], 0

    def add(self, query, cand, score) -> None:
        self.parts.append((query, cand, score))
        self.rows += len(query)
        if self.rows > 400_000:
            self.compact()

    def compact(self) -> None:
        query, cand, score = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.lexsort((cand, -score, query))
        query, cand, score = query[order], cand[order], score[order]
        new = np.ones(len(query), bool)
        new[1:] = (query[1:] != query[:-1]) | (cand[1:] != cand[:-1])
        query, cand, score = query[new], cand[new], score[new]
        first = np.flatnonzero(np.append(True, query[1:] != query[:-1])) if len(query) else np.zeros(0, int)
        rank = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query))))
        few = rank < self.keep
        self.parts = [(query[few], cand[few], score[few])]
        self.rows = int(few.sum())


def _rank_task(dim: int, keep: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(keep)
        key, queries, ids = None, [], []
        for batch in batches:
            unit = np.column_stack([batch.column("bucket").to_numpy(), batch.column("salt").to_numpy(),
                                    batch.column("is_candidate").to_numpy()]).astype(np.int64)
            cuts = [0, *(np.flatnonzero((unit[1:] != unit[:-1]).any(1)) + 1).tolist(), len(unit)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if lo == hi:
                    continue
                part = batch.slice(lo, hi - lo)
                if key != tuple(unit[lo, :2]):
                    key, queries, ids = tuple(unit[lo, :2]), [], []
                if not unit[lo, 2]:  # queries come first in a unit
                    queries.append(_matrix(part.column("vec"), dim))
                    ids.append(part.column("id").to_numpy())
                elif queries:
                    _compare(best, np.concatenate(queries), np.concatenate(ids), part, dim, keep)
        if best.parts:
            best.compact()
            query, cand, score = best.parts[0]
            yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(cand), pa.array(score)], ["query", "cand", "score"])
    return run


def _compare(best: _Best, q: np.ndarray, q_id: np.ndarray, part: pa.RecordBatch, dim: int, keep: int) -> None:
    for at in range(0, part.num_rows, BLOCK_ROWS):
        block = part.slice(at, BLOCK_ROWS)
        c, c_id = _matrix(block.column("vec"), dim), block.column("id").to_numpy()
        for lo in range(0, len(q), BLOCK_ROWS):
            some, some_id = q[lo:lo + BLOCK_ROWS], q_id[lo:lo + BLOCK_ROWS]
            at_q, at_c = _at_least(some, c, keep)
            best.add(some_id[at_q], c_id[at_c], _products(some, c, at_q, at_c))


def _at_least(q: np.ndarray, c: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs ``(row of q, row of c)`` of every candidate that reaches its query's
    ``keep``-th best product, ties of any number included. The products are
    fast ones, so the edge is lowered by a bound on their rounding."""
    fast = q @ c.T
    if len(c) <= keep:
        return tuple(x.ravel() for x in np.indices(fast.shape))
    edge = -np.partition(-fast, keep - 1, axis=1)[:, keep - 1]
    longest = np.sqrt((c * c).sum(1).max())
    rounding = 4 * q.shape[1] * np.finfo(float).eps * np.sqrt((q * q).sum(1)) * longest
    return np.nonzero(fast >= (edge - rounding)[:, None])


def _products(q: np.ndarray, c: np.ndarray, at_q: np.ndarray, at_c: np.ndarray) -> np.ndarray:
    """Inner products of the pairs, each summed in one fixed order."""
    parts = [np.einsum("ij,ij->i", q[at_q[lo:lo + PAIR_ROWS]], c[at_c[lo:lo + PAIR_ROWS]]) for lo in range(0, len(at_q), PAIR_ROWS)]
    return np.concatenate(parts) if parts else np.zeros(0)


def _ranked(candidates: DataFrame, probing: DataFrame, sizes: DataFrame, dim: int, keep: int, query_salts: int) -> DataFrame:
    """``query, cand, score`` of the best met in each task. A hot bucket's
    candidates are salted; all queries meet the whole bands' bucket, so there
    they are salted too."""
    queries = F.when(F.col("bucket") == _WHOLE, F.lit(query_salts)).otherwise(F.lit(1))
    salted = F.pmod(F.xxhash64("id"), F.col("salts")).cast("int")
    dealt = F.pmod(F.xxhash64("id"), queries).cast("int")
    candidates = (candidates.join(sizes, "bucket")
                  .select("bucket", F.explode(F.transform(F.sequence(F.lit(0), queries - 1), lambda q: salted * queries + q)).alias("salt"),
                          F.lit(1).alias("is_candidate"), "id", "vec"))
    probing = (probing.join(sizes, "bucket")
               .select("bucket", F.explode(F.transform(F.sequence(F.lit(0), F.col("salts") - 1), lambda c: c * queries + dealt)).alias("salt"),
                       F.lit(0).alias("is_candidate"), "id", "vec"))
    return (candidates.unionByName(probing).repartition("bucket", "salt").sortWithinPartitions("bucket", "salt", "is_candidate")
            .mapInArrow(_rank_task(dim, keep), "query long, cand long, score double").distinct())


def _nearest(found: DataFrame, keep: int) -> DataFrame:
    ranked = Window.partitionBy("query").orderBy(F.desc("score"), "cand")
    return found.withColumn("rn", F.row_number().over(ranked)).where(F.col("rn") <= keep)


def nearest_neighbours(df: DataFrame, is_query: Column, *, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K,
                       tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest found for every
    row that ``is_query`` (over ``id``) selects, against all other rows."""
    spark = df.sparkSession
    out = shared_dir(spark, "nearest", "vectors")
    (df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vec_col}`").alias("vec"))
       .mapInArrow(_valid_task, "id long, vec binary, dim int, length double").write.parquet(out))
    valid = spark.read.parquet(out)
    shape = valid.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.max("length").alias("hi"))
    common = shape.orderBy(F.desc("n"), "dim").first()
    dim = common["dim"] if common else 1
    band = F.floor((F.lit(math.log(common["hi"]) if common else 0.0) - F.log("length")) / F.lit(math.log(BAND_RATIO))).cast("int")
    rows = (valid.where(F.col("dim") == dim).select("id", "vec", "length", band.alias("band"))
            .withColumn("is_query", F.coalesce(is_query, F.lit(False))))
    spread = rows.groupBy("band").agg(F.approx_count_distinct("vec").alias("n"), F.min("length").alias("lo"), F.max("length").alias("hi"),
                                      F.count(F.when(F.col("is_query"), 1)).alias("asked")).orderBy("band").collect()
    bands = {r["band"]: r["hi"] if r["lo"] < 0.999 * r["hi"] else None for r in spread if r["n"] > WHOLE_ROWS}
    query_salts = sum(r["asked"] for r in spread) // QUERY_ROWS + 1

    first = Window.partitionBy("vec").orderBy("id")
    classes = (rows.withColumn("rn", F.row_number().over(first)).where(F.col("rn") <= k + 1)
               .groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids"), F.min("band").alias("band")))
    classes = classes.withColumn("class", F.element_at("ids", 1))
    asked = rows.where("is_query").select("vec").distinct().join(classes.select("vec", "class"), "vec")

    vectors = classes.select(F.col("class").alias("id"), "vec", "band")
    candidates = vectors.mapInArrow(_bucket_task(dim, tables, 1, bands, False), "bucket long, id long, vec binary")
    sizes = (vectors.mapInArrow(_bucket_task(dim, tables, 1, bands, False), "bucket long, id long, vec binary")
             .groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / BUCKET_ROWS).cast("int").alias("salts")))
    probing = (asked.select(F.col("class").alias("id"), "vec")
               .mapInArrow(_bucket_task(dim, tables, probes, bands, True), "bucket long, id long, vec binary"))
    found = _ranked(candidates, probing, sizes, dim, k + 1, query_salts)
    near = _nearest(found, k + 1)
    if bands:  # whole bands alone leave no candidate out
        met = shared_dir(spark, "nearest", "met")
        near.write.parquet(met)
        near = spark.read.parquet(met)
        enough = near.groupBy("query").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > k).select(F.col("query").alias("class"))
        short = asked.join(enough, "class", "left_anti").select(F.col("class").alias("id"), "vec")
        n_short = short.count()
        if n_short:
            whole = F.lit(_WHOLE).cast("long").alias("bucket")
            salts = vectors.select(whole).groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / BUCKET_ROWS).cast("int").alias("salts"))
            exact = _nearest(_ranked(vectors.select(whole, "id", "vec"), short.select(whole, "id", "vec"), salts, dim, k + 1,
                                     n_short // QUERY_ROWS + 1), k + 1)
            near = near.join(short.select(F.col("id").alias("query")), "query", "left_anti").unionByName(exact)
    # rows of the found classes, best first; k + 1 of them always leave k beside the query's own
    listed = (near.join(classes.select(F.col("class").alias("cand"), "ids"), "cand")
              .select("query", "score", F.explode("ids").alias("vec_id"))
              .groupBy("query").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("down"), "vec_id"))), 1, k + 1)
                                    .alias("near")))
    # a vector may stand in a third of all queries
    asking = rows.where("is_query").select("id", "vec")
    counted = asking.groupBy("vec").agg(F.count(F.lit(1)).alias("n")).join(classes.select("vec", F.col("class").alias("query")), "vec")
    queries = join_counted(asking, counted.join(listed, "query"), ["vec"], "n", sum(r["asked"] for r in spread), F.xxhash64("id")).select("id", "query", "near")
    own = F.array_position(F.transform("near", lambda x: x["vec_id"]), F.col("id")) - 1
    return (queries.withColumn("own", own)
            .withColumn("near", F.slice(F.filter("near", lambda x, i: i != F.col("own")), 1, k))
            .select(F.col("id").alias("query_id"), F.posexplode("near").alias("at", "hit"))
            .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"),
                    (-F.col("hit.down")).alias("score")))
