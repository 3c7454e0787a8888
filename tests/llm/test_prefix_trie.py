import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import prefix_trie as P
from tessera.llm.queries import _rebuilt

SCHEMA = "conv_id long, turn long, role string, text string, n_convs int, path string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0, "x") for r in rows], SCHEMA).repartition(5)


def ordered(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    return {c: [(x[2], x[4]) for x in sorted(t)] for c, t in convs.items()}


def mixed(convs):
    out = {}
    for c, t in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - int(np.fmod(c, 5)), [])[:h] + t[h:]
    return out


def brute(convs):
    """Every node's row, from the dictionary of all prefixes."""
    members = {}
    for c, t in convs.items():
        for d in range(len(t) + 1):
            members.setdefault(tuple(t[:d]), []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, kept = {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = children.get(p, [])
        leaves[p] = sum(leaves[q] for q in below) if below else 1
        kept[p] = sum(kept[q] for q in below) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0)
    rows = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(convs[c]) == len(p)))
        rows.append((min(m), len(p), min(members[p[:-1]]) if p else -99, len(m), len(children.get(p, [])), leaves[p], kept[p],
                     hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows)


def rows_of(df):
    return sorted(tuple(-99 if v is None else v for v in r) for r in df.collect())


def conversations(seed, n, choices, longest):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        length = rng.randrange(0, longest)
        for t in range(length):
            rows.append((c - 7, rng.choice([None, t, t, t]), rng.choice(["user", "user", None]), rng.choice(choices)))
    same = [(t, "user", f"common {t}") for t in range(5)]
    rows += [(c, *turn) for c in range(5000, 5000 + 40) for turn in same]
    rows += [(c, *turn) for c in range(6000, 6000 + 40) for turn in [*same, (9, "user", f"tail {c}"), (10, "user", f"own {c % 4}")]]
    return rows


@pytest.mark.parametrize("hot", [1, 4, 512])
@pytest.mark.parametrize("choices", [["a", "b", None, "é日", ""], [f"text {k}" for k in range(200)]])
def test_matches_brute_force(spark, hot, choices):
    rows = conversations(hot, 150, choices, 7)
    convs = ordered(rows)
    assert rows_of(P.trie_nodes(P.conversation_turns(frame(spark, rows)), hot=hot, shard_rows=20)) == brute(convs)
    assert rows_of(P.trie_nodes(_rebuilt(frame(spark, rows)), hot=hot)) == brute(mixed(convs))


def test_double_array_holds_exactly_the_sequences():
    rng = np.random.default_rng(3)
    for width in (1, 2, 9, 400):
        size = rng.integers(0, 8, 300)
        turns = rng.integers(0, width, size.sum())
        start = np.cumsum(size) - size
        trie = P.pack(turns, start, size)
        seqs = [tuple(turns[a:a + n].tolist()) for a, n in zip(start, size, strict=True)]
        prefixes = {s[:k] for s in seqs for k in range(len(s) + 1)}
        cell = {(): 0}
        for p in sorted(prefixes, key=len):
            if p:
                cell[p] = int(trie.child(np.array([cell[p[:-1]]]), np.array([p[-1]]))[0])
        assert -1 not in cell.values() and len(set(cell.values())) == len(prefixes)
        assert (trie.check >= 0).sum() == len(prefixes)
        for p in list(prefixes)[:100]:
            for t in range(min(width, 12)):
                found = int(trie.child(np.array([cell[p]]), np.array([t]))[0])
                assert found == cell.get((*p, t), -1)


def test_many_copies_are_hashed_in_blocks(spark):
    ids = [-5, *range(0, 9000, 3)]
    rows = [(c, 0, "user", "same") for c in ids]
    got = rows_of(P.trie_nodes(P.conversation_turns(frame(spark, rows))))
    assert got == brute(ordered(rows))


def test_edges(spark):
    assert P.trie_nodes(P.conversation_turns(frame(spark, []))).count() == 0
    assert P.trie_nodes(P.conversation_turns(frame(spark, [(None, 0, "user", "x")]))).count() == 0
    long = [(1, t, "user", "x" * 100_000 if t == 0 else str(t)) for t in range(300)]
    rows = [*long, (2, None, None, None), (2, None, None, None), (3, 1, "a", "b"), (3, 1, "a", "a")]
    d = frame(spark, rows)
    assert rows_of(P.trie_nodes(P.conversation_turns(d))) == brute(ordered(rows))
    turnless = P.conversation_turns(d).withColumn("turns", F.slice("turns", 1, 0)).withColumn("bytes", F.slice("bytes", 1, 0))
    ends = hashlib.sha256(b"1,2,3").hexdigest()
    assert rows_of(P.trie_nodes(turnless)) == [(1, 0, -99, 3, 0, 1, 0, ends)]
