import random
import re

import numpy as np
from edges import LONG, PROSE, docs, empty
from pyspark.sql import functions as F

from tessera.llm import quality_rules as Q
from tessera.llm.textarrays import utf8

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    """The counts of one text, word by word."""
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    seen = {}
    for g in windows:
        seen[g] = seen.get(g, 0) + 1
    covered = {i + k for i, g in enumerate(windows) if seen[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return [len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), len(lines)]


def texts(seed, n):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abé#|日x") for _ in range(rng.randrange(1, 3)))
    return ["".join(word() + rng.choice([" ", " ", "\n", "  ", "\t", "\r\n", "\v", "\n\n"]) for _ in range(rng.randrange(0, 60))) for _ in range(n)]


def test_counts_match_plain_code():
    import pyarrow as pa
    given = [*texts(1, 300), None, "", " \n ", "\n", "a b c a b c", "a a a a", LONG, PROSE + "\n" + PROSE, "x" * 5000]
    got = Q.text_counts(*utf8(pa.array(given)))
    assert got.tolist() == [plain(t) for t in given]


def quartiles(values):
    values = sorted(values)
    return [next(v for k, v in enumerate(values, 1) if 4 * k >= q * len(values)) for q in (1, 2, 3)]


def binned(v):
    spare = max(v.bit_length() - 7, 0)
    return v >> spare << spare


def brute(rows, min_docs):
    """``(base_failed, kept)`` of the ``(text, lang, source)`` rows, with sorted values for sketches."""
    counts = [dict(zip(Q.COUNTS, plain(t), strict=True)) for t, _, _ in rows]
    base = [c["n_words"] < 50 or 100 * c["n_repeat_words"] > 50 * c["n_words"] for c in counts]
    ratio = [[10000 * c[m.count] // max(c[m.per], 1) for m in Q.MEASURES] for c in counts]

    def fence(pick, k, m):
        q1, q2, q3 = quartiles([binned(r[k]) for r, b, (_, lg, sc) in zip(ratio, base, rows, strict=True) if not b and pick(lg, sc)])
        width = max(Q.SPREADS * min(q3 - q2, q2 - q1), m.room)
        return (q2 - width if m.both else -1), q2 + width

    out = []
    for (_, lang, source), b, r in zip(rows, base, ratio, strict=True):
        picks = (lambda lg, sc, lang=lang, source=source: (lg, sc) == (lang, source), lambda lg, sc, lang=lang: lg == lang, lambda lg, sc: True)
        kept = not b
        if kept:
            pick = next((p for p in picks[:2] if sum(not x and p(lg, sc) for x, (_, lg, sc) in zip(base, rows, strict=True)) >= min_docs), picks[2])
            kept = all(lo <= v <= hi for v, (lo, hi) in zip(r, (fence(pick, k, m) for k, m in enumerate(Q.MEASURES)), strict=True))
        out.append((b, kept))
    return out


def test_verdicts_match_brute_force(spark):
    rng = random.Random(4)

    def text(kind):
        w = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(3, 8) + 6 * (kind == 1))) + ("###" if kind == 2 else "") for _ in range(rng.randrange(40, 90))]
        line = " ".join(w[:12])
        return "\n".join([" ".join(w), *([line] * 6 if kind == 3 else [])])
    rows = [(text(rng.choice([0, 0, 0, 0, 1, 2, 3])), rng.choice(["en", "de", None]), rng.choice(["a", "a", "a", "b", None])) for _ in range(300)]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "doc_id long, text string, lang string, source string").repartition(7)
    want = brute(rows, 30)
    assert {k for _, k in want} == {True, False}
    for limit in (Q.BROADCAST_GROUPS, 1):  # broadcast, salted
        got = {r.doc_id: (r.base_failed, r.kept) for r in Q.filter_quality(df, min_docs=30, broadcast_groups=limit).collect()}
        assert [got[k] for k in range(len(rows))] == want


def test_a_quarter_of_bad_texts_does_not_move_the_fence(spark):
    rng = random.Random(2)
    clean = [" ".join("".join(rng.choice("abcdef") for _ in range(5)) for _ in range(60)) for _ in range(300)]
    bad = [t.replace(" ", "%%% ") for t in clean[:60]]
    df = spark.createDataFrame([(k, t, "en", "s") for k, t in enumerate(clean + bad)], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.kept for r in Q.filter_quality(df).collect()}
    assert all(got[k] == (k < 300) for k in got) and len(got) == 360


def test_edges(spark):
    d = docs(spark)
    out = Q.filter_quality(d)
    assert set(out.columns) == {*(set(d.columns) - {"text", "n_lines"}), *Q.RESULTS}
    want = sorted((r.doc_id or 0, *plain(r.text)) for r in d.collect())
    rows = out.collect()
    assert sorted((r.doc_id or 0, *(r[c] for c in Q.COUNTS)) for r in rows) == want
    assert all(r.base_failed and not r.kept for r in rows if r.n_words < 50)
    assert Q.filter_quality(empty(spark)).count() == 0
    clash = d.select("*", *(F.lit(1).alias(c) for c in ("lang_", "source_", "l", "s", "row", "fences", "salt", "salt_", "text_", "text__", "docs", "n")))
    assert clash.count() == Q.filter_quality(clash).where("lang_ + source_ + l + s + row + fences + salt + salt_ + text_ + text__ + docs + n = 12").count()
    short = spark.createDataFrame([(1, "few words", "en", "a")], "doc_id long, text string, lang string, source string")
    assert [(r.base_failed, r.kept) for r in Q.filter_quality(short).collect()] == [(True, False)]
    assert np.array_equal(Q.text_counts(np.zeros(0, np.uint8), np.zeros(1, np.int64)), np.zeros((0, 6)))
