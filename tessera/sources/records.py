"""Records of delimited files whose quoted fields may hold line breaks, each
file read by many tasks.

Spark splits a text file at any line break, so a task doesn't know whether its
first line begins a record or goes on in a quoted field. Whether it does is
found in two steps: every line either keeps that state, turns it over, or sets
it, whatever it was before; lines compose to splits, and splits, in the order
of their offsets, give the state at the start of every split (one row per
split). Tasks then join lines to records; the pieces of a record that crosses
splits are put together by one small aggregation.

A quote opens a field only at its start, and a doubled quote stands for one, as
in the reader for whole files. Lines end in LF or CR LF; files with bare CR
between records have to be read whole (``split=False`` of the readers).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import decode_path
from ..operators.numbering import read_split_lines
from ..session import saved

#: Splits whose states are broadcast (under 200 bytes each); more are joined by a shuffle.
BROADCAST_SPLITS = 100_000
HEAD_BUFFER = 8192
HEAD_THREADS = 16


class Quoting:
    """How one line changes the state "within a quoted field"."""

    def __init__(self, sep: str):
        if len(sep) != 1:
            raise ValueError(f"separator {sep!r} is not a single character")
        s, c = re.escape(sep), "\\" + sep if sep in "\\]^-" else sep
        plain = f'[^"{c}][^{c}]*'
        field = f'(?:"(?:[^"]|"")*"(?:{plain})?|{plain}|)'
        self._closed_outside = f"^{field}(?:{s}{field})*$"
        self._closed_inside = f'^(?:[^"]|"")*"(?:{plain})?(?:{s}{field})*$'

    def after(self, lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """For every line, the state after it if it begins outside, and inside, of quotes."""
        n = len(lines)
        outside, inside = np.zeros(n, bool), np.ones(n, bool)
        quoted = np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False))
        if len(quoted):
            some = lines.take(pa.array(quoted))
            outside[quoted] = ~pc.match_substring_regex(some, self._closed_outside).to_numpy(zero_copy_only=False)
            inside[quoted] = ~pc.match_substring_regex(some, self._closed_inside).to_numpy(zero_copy_only=False)
        return outside, inside


def states(outside: np.ndarray, inside: np.ndarray, start: bool) -> np.ndarray:
    """The state before every line, and after the last one."""
    n = len(outside)
    sets = outside == inside
    turns = np.concatenate([[0], np.cumsum(outside & ~inside)])
    last = np.maximum.accumulate(np.concatenate([[-1], np.where(sets, np.arange(n), -1)]))
    known = last >= 0
    at = np.maximum(last, 0)
    base = np.where(known, outside[at] if n else False, start)
    since = turns - np.where(known, turns[at + 1] if n else 0, 0)
    return base ^ (since % 2 == 1)


def _segments(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], int, int]]:
    """Runs of rows of one split."""
    if not batch.num_rows:
        return
    file = batch.column("file_path").dictionary_encode()
    code, split = file.indices.to_numpy(), batch.column("_split").to_numpy()
    cut = np.flatnonzero((code[1:] != code[:-1]) | (split[1:] != split[:-1])) + 1
    for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows], strict=True):
        yield (file.dictionary[int(code[lo])].as_py(), int(split[lo])), lo, hi


def _split_task(sep: str):
    """What each split does to the state (only lines with quotes matter)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quoting, key, ends = Quoting(sep), None, (False, True)

        def row():
            return pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]], pa.int64()), pa.array([ends[0]]), pa.array([ends[1]])],
                                              ["file_path", "_split", "outside", "inside"])

        for batch in batches:
            for k, lo, hi in _segments(batch):
                if k != key:
                    if key is not None:
                        yield row()
                    key, ends = k, (False, True)
                after = quoting.after(batch.column("value").slice(lo, hi - lo))
                ends = tuple(bool(states(*after, e)[-1]) for e in ends)
        if key is not None:
            yield row()
    return run


def _starts(lines: DataFrame, sep: str) -> DataFrame:
    """``file_path, _split, starts_inside, ends_inside`` of every split."""
    quoted = (lines.where(F.contains("value", F.lit('"'))).select("value", "file_path", "_split")
              .mapInArrow(_split_task(sep), "file_path string, _split long, outside boolean, inside boolean"))
    every = lines.select("file_path", "_split").distinct().join(quoted, ["file_path", "_split"], "left").select(
        "file_path", "_split", F.coalesce("outside", F.lit(False)).alias("o"), F.coalesce("inside", F.lit(True)).alias("i"))
    upto = Window.partitionBy("file_path").orderBy("_split")
    before = upto.rowsBetween(Window.unboundedPreceding, -1)
    turn = (F.col("o") & ~F.col("i")).cast("int")
    turned = every.withColumn("turns", F.sum(turn).over(upto.rowsBetween(Window.unboundedPreceding, 0)))
    placed = turned.withColumn("set", F.last(F.when(F.col("o") == F.col("i"), F.struct("o", "turns")), ignorenulls=True).over(before))
    since = F.col("turns") - turn - F.coalesce(F.col("set.turns"), F.lit(0))
    start = F.coalesce(F.col("set.o"), F.lit(False)) != (since % 2 == 1)
    return (placed.withColumn("starts_inside", start)
            .select("file_path", "_split", "starts_inside", F.when(F.col("starts_inside"), F.col("i")).otherwise(F.col("o")).alias("ends_inside")))


# Kinds of rows that a task makes of lines.
RECORD, REST, HEAD = 0, 1, 2


def _record_task(sep: str):
    """Lines of each split joined to records; the lines that end a record of an
    earlier split are a REST, those of a record that goes on in the next a HEAD."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quoting = Quoting(sep)
        key, inside, open_, kind, first = None, False, [], RECORD, False

        def rows(records: list[pa.Array], kinds: list[int]) -> pa.RecordBatch:
            """``first`` marks the first record of a file that is not blank."""
            nonlocal first
            texts = pa.concat_arrays(records)
            n = len(texts)
            marks = np.zeros(n, bool)
            if first:
                some = np.flatnonzero(~np.isin(np.array(texts.slice(0, 1000).to_pylist(), object), ("", "\r")))
                if len(some):
                    marks[some[0]], first = True, False
            return pa.RecordBatch.from_arrays([pa.array([key[0]] * n, pa.string()), pa.array(np.full(n, key[1])), pa.array(np.array(kinds, np.int32)),
                                               pa.array(marks), texts], ["file_path", "_split", "kind", "first", "record"])

        def closing() -> Iterator[pa.RecordBatch]:
            if open_:
                yield rows([pa.array(["\n".join(open_)])], [REST if kind == REST else HEAD if inside else RECORD])

        for batch in batches:
            for k, lo, hi in _segments(batch):
                if k != key:
                    yield from closing()
                    key, inside, open_, first = k, batch.column("starts_inside")[lo].as_py(), [], k[1] == 0
                    kind = REST if inside else RECORD
                lines = batch.column("value").slice(lo, hi - lo)
                state = states(*quoting.after(lines), inside)
                begin = np.flatnonzero(~state[:-1])
                inside = bool(state[-1])
                until = int(begin[0]) if len(begin) else len(lines)
                open_ += lines.slice(0, until).to_pylist()
                if not len(begin):
                    continue
                out, kinds = [], []
                if open_:
                    out.append(pa.array(["\n".join(open_)], pa.string()))
                    kinds.append(kind)
                whole = pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), lines)  # all records but the last begun
                out.append(pc.binary_join(whole, "\n").cast(pa.string()))
                kinds += [RECORD] * len(whole)
                open_, kind = lines.slice(int(begin[-1])).to_pylist(), RECORD
                if kinds:
                    yield rows(out, kinds)
        yield from closing()
    return run


ROWS = "file_path string, _split long, kind int, first boolean, record string"


def read_records(spark: SparkSession, files: str | list[str], sep: str, *, broadcast_splits: int = BROADCAST_SPLITS) -> DataFrame:
    """``file_path, first, record``: the records of the files, blank ones left
    out; ``first`` marks each file's first record (its header). Line breaks
    within a record stay as they are, the one that ends it is left out."""
    lines = read_split_lines(spark, files, "\n")
    starts = saved(_starts(lines, sep), "records", "splits")

    def joined(which: DataFrame) -> DataFrame:
        which = which.select("file_path", "_split", "starts_inside")
        if which.limit(broadcast_splits + 1).count() <= broadcast_splits:  # the lines keep their order
            return lines.join(F.broadcast(which), ["file_path", "_split"]).select("value", "file_path", "_split", "starts_inside")
        return (lines.join(which.hint("shuffle_merge"), ["file_path", "_split"]).sortWithinPartitions("file_path", "_split", "_id")
                .select("value", "file_path", "_split", "starts_inside"))

    rows = joined(starts).mapInArrow(_record_task(sep), ROWS).where(F.col("kind") == RECORD).select("file_path", "first", "record")
    crossed = starts.where("starts_inside or ends_inside")
    if crossed.limit(1).count():
        pieces = joined(crossed).mapInArrow(_record_task(sep), ROWS).where(F.col("kind") != RECORD)
        order = Window.partitionBy("file_path").orderBy("_split", "kind")
        stitched = (pieces.withColumn("n", F.sum((F.col("kind") == HEAD).cast("int")).over(order))
                    .groupBy("file_path", "n").agg(F.max("first").alias("first"), F.array_sort(F.collect_list(F.struct("_split", "kind", "record"))).alias("p"))
                    .select("file_path", "first", F.array_join(F.col("p.record"), "\n").alias("record")))
        rows = rows.unionByName(stitched)
    whole = F.when(F.endswith("record", F.lit("\r")), F.substring(F.col("record"), F.lit(1), F.length("record") - 1)).otherwise(F.col("record"))
    return rows.withColumn("record", whole).where("record <> ''")


def _head(spark: SparkSession, path: str, quoting: Quoting) -> str | None:
    """A file's first record that is not blank. Only a read buffer is asked of
    the file's store, and only the record itself leaves the JVM."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path))
    stream = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(where, HEAD_BUFFER)
    try:
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"), HEAD_BUFFER)
        held, inside = [], False
        while (line := lines.readLine()) is not None:
            if held or line:
                held.append(line)
                inside = bool(quoting.after(pa.array([line]))[int(inside)][0])
                if not inside:
                    break
        return "\n".join(held) if held else None
    finally:
        stream.close()


def read_heads(spark: SparkSession, path: str | list[str], sep: str) -> list[tuple[str, str]]:
    """``(file_path, head)``: the first record of every file that has one.

    Like the listing of the files, this is asked of the file system and not of
    a Spark job, as a scan task would read a file to its end. Several files are
    asked for at a time.
    """
    files = spark.read.text(path).inputFiles()
    quoting = Quoting(sep)
    with ThreadPoolExecutor(HEAD_THREADS) as pool:
        heads = list(pool.map(lambda f: _head(spark, f, quoting), files))
    found = [(f, h) for f, h in zip(files, heads, strict=True) if h is not None]
    decoded = spark.createDataFrame(found, "file string, head string").select(decode_path(F.col("file")).alias("file"), "head")
    return sorted((r["file"], r["head"]) for r in decoded.collect())
