import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from edges import docs, empty

from tessera.llm import collocations as C

A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(A_Z))]


def counted(texts):
    f = Counter()
    for t in texts:
        for w in pieces(t):
            for k in (1, 2, 3):
                f.update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    return f


def brute(rows, least, cover=50, top=2000):
    """``(lang, rank, phrase, a, l, r, n, score)`` of the ``(text, lang)`` rows."""
    out = []
    for lang in {lg or "und" for _, lg in rows}:
        f = counted([t for t, lg in rows if (lg or "und") == lang])
        n = sum(a for g, a in f.items() if len(g) == 1)
        cands = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        covered = {}
        for g, a in cands.items():
            if len(g) == 3:
                for part in (g[:2], g[1:]):
                    covered[part] = max(covered.get(part, 0), a)
        scored = []
        for g, a in cands.items():
            if 100 * covered.get(g, 0) >= cover * a and g in covered:
                continue
            score, k = min((1_000_000 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            scored.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "doc_id long, text string, lang string").repartition(5)


def corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = ["a", "B", "the", "日本", "é", "x#", "|"]
    gap = [" "] * 12 + ["  ", "\t", ". ", ",", "\n", "\r\n", " !? ", "\v", " ; "]
    rows = [("".join(rng.choice(vocabulary) + rng.choice(gap) for _ in range(rng.randrange(0, 80))), rng.choice(["en", "de", None, "und"])) for _ in range(n)]
    return rows + [rows[0]] * 15 + [(None, "en"), ("", "fr"), (" .,\n", "es"), ("Ab " * 200, "it"), ("one", "pt")]


@pytest.mark.parametrize("trigger", [1, 3, 32, 10**9])
def test_every_cut_counts_alike(spark, trigger):
    rows = corpus(3, 60)
    got = sorted(tuple(r) for r in C.collocations(frame(spark, rows), trigger=trigger).collect())
    assert got == brute(rows, 10)


def test_least_and_top(spark):
    rows = corpus(9, 40)
    assert sorted(tuple(r) for r in C.collocations(frame(spark, rows), least=2, top=7).collect()) == brute(rows, 2, top=7)
    assert sorted(tuple(r) for r in C.collocations(frame(spark, rows * 3), least=300).collect()) == brute(rows * 3, 300)


def test_crowded_parts_are_salted(spark, monkeypatch):
    monkeypatch.setattr(C, "HOT_ROWS", 1)
    monkeypatch.setattr(C, "MAX_HOT", 10**6)
    rows = corpus(5, 60)
    assert sorted(tuple(r) for r in C.collocations(frame(spark, rows), least=3).collect()) == brute(rows, 3)


def test_large_products_stay_exact(spark):
    f = 3_000_000_019
    df = spark.createDataFrame([(f, f + 10**9, 7 * 10**12)], "a long, l long, r long")
    assert df.select(C._score("l", "r").alias("s")).first().s == 1_000_000 * f * f // ((f + 10**9) * 7 * 10**12)


def test_chunks_are_shared_by_equal_passages():
    rng = random.Random(1)
    passage = " ".join(f"w{rng.randrange(300)}" for _ in range(600))
    texts = [f"start {k} of it. {passage}, end {k}" for k in range(5)]
    flat, start, end, row, breaks = C.normal_form(*C.utf8(pa.array(texts)))
    first, last, closing = C.chunk_bounds(flat, start, end, row, breaks, C.TRIGGER)
    chunks = C.strings(flat, start[first], end[last]).to_pylist()
    assert closing.sum() == 5
    assert len(set(chunks)) < len(chunks) / 3
    assert max(Counter(chunks).values()) == 5


def test_edges(spark):
    d = docs(spark).drop("rank")
    rows = [(r.text, r.lang) for r in d.collect()]
    assert sorted(tuple(r) for r in C.collocations(d).collect()) == brute(rows, 10)
    assert C.collocations(empty(spark)).count() == 0
    assert C.collocations(frame(spark, [(None, None), ("", "en"), ("a b", "en")])).count() == 0
