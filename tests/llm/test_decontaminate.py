import random

import numpy as np
from edges import docs, empty

from tessera.llm import decontaminate as D

ITEM_SCHEMA = "item_id long, text string"


def distance(a, b):
    """Smallest word edit distance of ``a`` to any run of ``b``."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_edit_windows_match_brute_force():
    rng = random.Random(1)
    for _ in range(200):
        a = [rng.randrange(4) for _ in range(rng.randrange(1, 9))]
        b = [rng.randrange(4) for _ in range(rng.randrange(1, 15))]
        got, start, end = D.edit_windows(np.array(a, np.uint64), np.array([b], np.uint64))
        assert got[0] == distance(a, b)
        assert distance(a, b[start[0]:end[0]]) == got[0]


def test_finds_edited_items_and_nothing_else(spark):
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8))) for _ in range(400)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(k, text(rng.randrange(15, 60))) for k in range(40)]
    rows, truth = [], set()
    for i in range(300):
        words = text(rng.randrange(0, 300))
        if i % 2:
            k, item = rng.choice(items)
            edited = list(item)
            for _ in range(rng.randrange(0, 1 + int(0.25 * len(item)))):
                p = rng.randrange(len(edited))
                edited[p:p + 1] = rng.choice([[], ["zzz"], [edited[p], "yyy"]])
            at = rng.randrange(len(words) + 1)
            words[at:at] = edited
        rows.append((i, " ".join(w.capitalize() if rng.random() < 0.1 else w for w in words)))
        truth |= {(i, k, distance(item, words)) for k, item in items if distance(item, words) <= int(0.2 * len(item))}
    d = spark.createDataFrame(rows, "doc_id long, text string")
    b = spark.createDataFrame([(k, " ".join(w)) for k, w in items], ITEM_SCHEMA)
    got = {(r.doc_id, r.item_id, r.distance) for r in D.leaks(d, b).collect()}
    assert got <= truth
    assert len(got) >= 0.98 * len(truth) > 50
    kept = {r.doc_id for r in D.without_leaks(d, b).collect()}
    assert kept == {i for i, _ in rows} - {i for i, _, _ in got}


def test_edges(spark):
    d = docs(spark)
    b = spark.createDataFrame([(1, "a little longer and a second line of the very same text"), (2, None), (3, ""),
                               (4, "a second line of the very same text, a LITTLE longer!"), (4, "no such text stands in any of the documents here"),
                               (5, "one")], ITEM_SCHEMA)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.item_id, r.distance) for r in D.leaks(d, b).collect())
    assert got == [(False, 1, 4, 0), (False, 2, 4, 0), (False, 2, 4, 0), (False, 10, 5, 0), (False, 11, 5, 0), (False, 12, 5, 0),
                   (True, 0, 4, 0)] or [g for g in got if g[2] == 4] == [(False, 1, 4, 0), (False, 2, 4, 0), (False, 2, 4, 0), (True, 0, 4, 0)]
    assert sorted(map(repr, D.leaks(d, b, broadcast_words=0).collect())) == sorted(map(repr, D.leaks(d, b).collect()))
    for words in (D.BROADCAST_WORDS, 0):
        clean = D.without_leaks(d, b, broadcast_words=words)
        assert clean.columns == d.columns
        assert D.leaks(empty(spark), b, broadcast_words=words).count() == 0 == D.without_leaks(empty(spark), b, broadcast_words=words).count()
    assert D.leaks(empty(spark), b).count() == 0
    assert D.without_leaks(d, b.where("item_id > 99")).count() == d.count()
    assert D.leaks(d, b.where("item_id > 99")).count() == 0


def test_short_items_are_found_whole_and_with_all_allowed_edits(spark):
    rng = random.Random(11)
    text = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    items = [(n * 10 + k, text(n)) for n in range(1, 24) for k in range(4)]
    rows, truth = [], set()
    for i, (k, item) in enumerate(items * 2):
        edited = list(item)
        for _ in range(int(0.2 * len(item)) if i < len(items) else 0):
            p = rng.randrange(len(edited))
            edited[p:p + 1] = rng.choice([[], ["zzz"], [edited[p], "yyy"]])
        words = text(30) + edited + text(40)
        rows.append((i, " ".join(words)))
        truth |= {(i, j, distance(other, words)) for j, other in items if distance(other, words) <= int(0.2 * len(other))}
    d = spark.createDataFrame(rows, "doc_id long, text string")
    b = spark.createDataFrame([(k, " ".join(w)) for k, w in items], ITEM_SCHEMA)
    assert {(r.doc_id, r.item_id, r.distance) for r in D.leaks(d, b).collect()} == truth
    assert D.without_leaks(d, b).count() == 0


def test_one_word_item_gives_its_exact_rows(spark):
    b = spark.createDataFrame([(1, "a little longer and a second line of the very same text"), (2, None), (3, ""),
                               (4, "a second line of the very same text, a LITTLE longer!"), (5, "one")], ITEM_SCHEMA)
    got = sorted((r.doc_id or 0, r.item_id, r.distance, r.item_words) for r in D.leaks(docs(spark), b).collect())
    prose = [(4, 0, 11), (5, 0, 1)]  # begins with "One"
    assert got == sorted((i, *hit) for i, hits in ((1, prose), (2, prose), (2, prose), (0, prose), (10, prose[1:]), (11, prose[1:]),
                                                   (12, prose[1:])) for hit in hits)


def places(a, b):
    """Smallest distance of ``a`` to any run of ``b``, and the smallest start of such a run."""
    best = None
    for s in range(len(b) + 1):
        row = list(range(len(a) + 1))  # distances of the beginnings of a to the run so far
        least = row[-1]
        for w in b[s:]:
            new = [row[0] + 1]
            for i, x in enumerate(a, 1):
                new.append(min(row[i - 1] + (x != w), row[i] + 1, new[i - 1] + 1))
            row = new
            least = min(least, row[-1])
        if best is None or least < best[0]:
            best = (least, s)
    return best


def test_all_columns_match_brute_force(spark):
    rng = random.Random(21)
    text = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    items = [(n * 10 + k, text(n)) for n in (1, 3, 5, 8, 14, 23, 24, 31) for k in range(2)]
    items.append((999, items[5][1]))  # a repeated item
    rows = []
    for i in range(70):
        words = text(rng.randrange(0, 25))
        for _ in range(rng.randrange(0, 3)):
            edited = list(rng.choice(items)[1])
            for _ in range(rng.randrange(0, 1 + int(0.2 * len(edited)))):
                p = rng.randrange(len(edited))
                edited[p:p + 1] = rng.choice([[], ["zzz"], [edited[p], "yyy"]])
            words += edited + text(rng.randrange(0, 20))
        rows.append((i, words))
    rows += [(3, rows[3][1]), (3, text(4) + items[0][1])]  # a repeated row, another with its id
    want = []
    for i, words in rows:
        for k, item in items:
            d, start = places(item, words)
            if d <= int(0.2 * len(item)):
                want.append((i, k, d, len(item), start))
    d = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string").repartition(6)
    b = spark.createDataFrame([(k, " ".join(w)) for k, w in items], ITEM_SCHEMA)
    for words in (D.BROADCAST_WORDS, 0):  # held by tasks, joined
        got = sorted(tuple(r) for r in D.leaks(d, b, broadcast_words=words).collect())
        assert got == sorted(want) and len(got) > 50
        clean = D.without_leaks(d, b, broadcast_words=words)
        assert clean.columns == d.columns
        texts = {" ".join(w) for i, w in rows if any(places(item, w)[0] <= int(0.2 * len(item)) for _, item in items)}
        assert sorted(r.text for r in clean.collect()) == sorted(" ".join(w) for _, w in rows if " ".join(w) not in texts)
