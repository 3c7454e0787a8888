"""URL filter: a sorted array of 64-bit digests, memory-mapped by the tasks.

Rules are ``(host, path, verdict)``. A rule fits a URL whose host is the
rule's host or one of its subdomains and whose path starts with the rule's
path; of the fitting rules the longest (host and path together) decides. A
URL that no rule fits gets the default verdict.

Every rule is one key, ``host + path``. The index holds the keys' xxhash64
digests in ascending order, the offsets of the full strings, and the strings.
A task memory-maps the index, hashes every (host suffix, path prefix) that can
be a key, finds the digests by vectorised binary search, and compares the full
strings of the hits, so that a digest collision never decides.

The index is sent to the executors with ``addFile``, which is only done up to
``max_index_bytes``; a longer list is judged by an equi-join on the key
instead (``judge_by_join``), which shuffles both sides and has no bound.

Defined results: a null URL or one without ``://`` has an empty host and path,
fits no rule and gets the default verdict. Every input row gives one row;
repeated rows give repeated rows. Other columns of the input are not read, so
their names cannot clash. An empty table gives an empty result. A duplicate
rule key with different verdicts is an error.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .textarrays import SLICE_BYTES, slices

MAX_INDEX_BYTES = 256_000_000
VERDICTS = ("allow", "block")
_MAGIC = np.int64(0x7465737365726131)


def host_and_path(url: F.Column) -> tuple[F.Column, F.Column]:
    """Host (after the first ``://`` up to ``/ ? #``, A-Z lower-cased) and path
    (then up to ``? #``) as column expressions; both empty for a null URL."""
    u = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, u.substr(at + 3, F.length(u))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    ascii_lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return ascii_lower, path


def build_index(rules: Iterable[tuple[str, str, str]]) -> bytes:
    """Index image: header, digests, string offsets, host lengths, verdicts, strings."""
    verdict_of: dict[tuple[str, str], str] = {}
    for host, path, verdict in rules:
        if verdict not in VERDICTS:
            raise ValueError(f"rule {host}{path}: verdict {verdict!r} is neither allow nor block")
        if verdict_of.setdefault((host, path), verdict) != verdict:
            raise ValueError(f"rule {host}{path} has two verdicts")
    entries = sorted((xxhash.xxh64_intdigest((h + p).encode()), h, p, v) for (h, p), v in verdict_of.items())
    keys = [(h + p).encode() for _, h, p, _ in entries]
    ints = lambda values: np.asarray(values, np.int64).tobytes()
    return b"".join([
        ints([_MAGIC, len(entries)]),
        np.array([d for d, *_ in entries], np.uint64).tobytes(),
        ints(np.concatenate([[0], np.cumsum([len(k) for k in keys])])),
        ints([len(h.encode()) for _, h, _, _ in entries]),
        ints([VERDICTS.index(v) for *_, v in entries]),
        b"".join(keys),
    ])


class DigestIndex:
    """A memory-mapped index image."""

    def __init__(self, path: str):
        image = np.memmap(path, np.uint8, "r")
        magic, n = image[:16].view(np.int64)
        if magic != _MAGIC:
            raise ValueError("not a URL index")
        at = 16
        self.digests = image[at:at + 8 * n].view(np.uint64)
        at += 8 * n
        self.offsets = image[at:at + 8 * (n + 1)].view(np.int64)
        at += 8 * (n + 1)
        self.host_length = image[at:at + 8 * n].view(np.int64)
        at += 8 * n
        self.verdicts = image[at:at + 8 * n].view(np.int64)
        self.text = image[at + 8 * n:]
        # lengths that keys have: other prefixes and suffixes need no probe
        self.path_lengths = np.unique(np.diff(self.offsets) - self.host_length).tolist()
        self.host_lengths = set(np.unique(self.host_length).tolist())

    def keys_of(self, host: bytes, path: bytes) -> list[tuple[bytes, int]]:
        """Strings that are the key of a rule that fits, longest first, with their host length."""
        suffixes = [host] + [host[i + 1:] for i, c in enumerate(host) if c == 46]
        found = [(s + path[:k], len(s)) for s in suffixes if len(s) in self.host_lengths
                 for k in self.path_lengths if k <= len(path)]
        return sorted(found, key=lambda x: (-len(x[0]), -x[1]))

    def probe(self, hosts: list[bytes], paths: list[bytes]) -> np.ndarray:
        """Index of each URL's deciding rule, or -1."""
        candidates = [self.keys_of(h, p) for h, p in zip(hosts, paths, strict=True)]
        flat = [c for keys in candidates for c in keys]
        row = np.repeat(np.arange(len(hosts)), [len(c) for c in candidates])
        digests = np.fromiter((xxhash.xxh64_intdigest(k) for k, _ in flat), np.uint64, len(flat))
        best = np.full(len(hosts), -1)
        lo = np.searchsorted(self.digests, digests, side="left")
        hi = np.searchsorted(self.digests, digests, side="right")
        for i in np.flatnonzero(hi > lo)[::-1]:  # backwards: the longest key of a row is written last
            key, length = flat[i]
            for j in range(lo[i], hi[i]):
                if self.host_length[j] == length and self.text[self.offsets[j]:self.offsets[j + 1]].tobytes() == key:
                    best[row[i]] = j
        return best


def judge_urls(df: DataFrame, rules: Iterable[tuple[str, str, str]], *, id_col: str = "page_id",
               url_col: str = "url", default: str = "allow", max_index_bytes: int = MAX_INDEX_BYTES) -> DataFrame:
    """``id_col, host, path, rule, verdict`` for every row of ``df``."""
    rules = list(rules)
    image = build_index(rules)
    host, path = host_and_path(F.col(f"`{url_col}`"))
    urls = df.select(F.col(f"`{id_col}`").alias("id"), host.alias("host"), path.alias("path"))
    if len(image) > max_index_bytes:
        judged = judge_by_join(urls, rules, default)
    else:
        name = _ship(df.sparkSession, image)
        judged = urls.mapInArrow(_probe_task(name, default), _schema(urls))
    return judged.withColumnRenamed("id", id_col)


def _schema(urls: DataFrame) -> str:
    return f"id {urls.schema['id'].dataType.simpleString()}, host string, path string, rule string, verdict string"


def _ship(spark: SparkSession, image: bytes) -> str:
    """Give every executor its own copy of the index, named by its content."""
    name = f"url-index-{hashlib.sha256(image).hexdigest()[:24]}.bin"
    folder = tempfile.mkdtemp(prefix="url-index-")  # read by the driver's file server only
    with open(os.path.join(folder, name), "wb") as out:
        out.write(image)
    added = spark.sparkContext.listFiles
    if not any(f.endswith("/" + name) for f in added):
        spark.sparkContext.addFile(os.path.join(folder, name))
    return name


def _probe_task(name: str, default: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = DigestIndex(SparkFiles.get(name))
        for batch in batches:
            for part in slices(batch, "path", SLICE_BYTES):
                hosts = [x.encode() for x in part.column("host").to_pylist()]
                paths = [x.encode() for x in part.column("path").to_pylist()]
                best = index.probe(hosts, paths)
                rule = [index.text[index.offsets[j]:index.offsets[j + 1]].tobytes().decode() if j >= 0 else None for j in best]
                verdict = [VERDICTS[index.verdicts[j]] if j >= 0 else default for j in best]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("host"), part.column("path"),
                     pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                    ["id", "host", "path", "rule", "verdict"])
    return run


def judge_by_join(urls: DataFrame, rules: list[tuple[str, str, str]], default: str) -> DataFrame:
    """The same verdicts for lists beyond the shipped size: an equi-join of each
    distinct (host, path)'s possible keys with the rules, then the longest per URL."""
    spark = urls.sparkSession
    table = spark.createDataFrame([(h, p, v) for h, p, v in rules], "r_host string, r_path string, r_verdict string").distinct()
    lengths = sorted({len(p) for _, p, _ in rules})
    pairs = urls.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    keys = (pairs
            .withColumn("k", F.explode(F.sequence(F.lit(1), F.size(labels))))
            .withColumn("r_host", F.array_join(F.slice(labels, F.col("k"), F.size(labels)), "."))
            .withColumn("n", F.explode(F.array(*[F.lit(n) for n in lengths])))
            .where(F.col("n") <= F.length("path"))
            .withColumn("r_path", F.substring("path", F.lit(1), F.col("n"))))
    best = (keys.join(table, ["r_host", "r_path"])
            .groupBy("host", "path")
            .agg(F.max(F.struct(F.length(F.concat("r_host", "r_path")).alias("n"), F.length("r_host").alias("h"),
                                F.concat("r_host", "r_path").alias("rule"), F.col("r_verdict").alias("verdict"))).alias("best")))
    return (urls.join(best, ["host", "path"], "left")
            .select("id", "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))
