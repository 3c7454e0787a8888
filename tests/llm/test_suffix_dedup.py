import collections
import hashlib
import random

import numpy as np
import pytest
from edges import docs, empty

from tessera.llm import suffix_dedup as S


def brute(texts, length):
    """Kept bytes and removed spans of each text."""
    data = [(t or "").encode() for t in texts]
    count = collections.Counter(b[i:i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if count[b[i:i + length]] > 1:
                gone[i:i + length] = True
        edge = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]]).astype(int)))
        out.append((bytes(x for x, g in zip(b, gone, strict=True) if not g), list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))))
    return out


def test_interval_expansion_matches_brute_force():
    rng = random.Random(5)
    for _ in range(150):
        length = rng.choice([1, 2, 5, 9, 16, 30])
        alphabet = rng.choice([b"a", b"ab", b"abcd", bytes(range(256))])
        base = [bytes(rng.choice(alphabet) for _ in range(rng.randrange(1, 120))) for _ in range(rng.randrange(1, 6))]
        parts = [(rng.choice(base)[rng.randrange(4):] + rng.choice(base))[:150] for _ in range(rng.randrange(1, 8))]
        count = collections.Counter(p[i:i + length] for p in parts for i in range(len(p) - length + 1))
        got = S.repeated_starts([np.frombuffer(p, np.uint8) for p in parts], length)
        assert [g.tolist() for g in got] == [[i for i in range(len(p) - length + 1) if count[p[i:i + length]] > 1] for p in parts]


@pytest.mark.parametrize("hot", [1, 1000])
def test_matches_brute_force(spark, hot):
    rng = random.Random(hot)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, base = text(30), text(120)
    texts = [text(rng.randrange(0, 100)) + (passage if i % 3 == 0 else "") + text(20) for i in range(60)]
    texts += [base[:rng.randrange(len(base))] + word() + base[rng.randrange(len(base)):] for _ in range(40)]
    texts += [base, base, None, "", "z" * 500, passage]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sorted(S.dedup_suffixes(df, length=60, hot_classes=hot).collect())
    for r, (kept, spans) in zip(rows, brute(texts, 60), strict=True):
        assert bytes(r.kept) == kept
        assert [(s.start, s.end) for s in r.removed] == spans
        assert r.n_bytes == len((texts[r.doc_id] or "").encode())


def test_edges(spark):
    d = docs(spark)
    rows = S.dedup_suffixes(d).collect()
    texts = [r.text for r in d.collect()]
    want = sorted((r[0] or 0, hashlib.sha256(k).hexdigest()) for r, (k, _) in zip(d.collect(), brute(texts, 400), strict=True))
    assert sorted((r.doc_id or 0, hashlib.sha256(r.kept).hexdigest()) for r in rows) == want
    assert S.dedup_suffixes(empty(spark)).count() == 0


def test_whole_table_matches_brute_force(spark):
    rows = S.dedup_suffixes(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).collect()
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()
    want = brute([r.text for r in d], 400)
    got = {r.doc_id: (bytes(r.kept), [(s.start, s.end) for s in r.removed]) for r in rows}
    assert len(got) == len(d) and sum(bool(spans) for _, spans in want) > 5
    assert all(got[r.doc_id] == w for r, w in zip(d, want, strict=True))
