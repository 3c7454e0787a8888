import collections
import random

import numpy as np
import pytest
from edges import docs, empty

from tessera.llm.components import connected_components
from tessera.llm.ngram_join import BELOW, LEAST_ESTIMATE, N_MINS, common_levels, joined_components, ngram_links, prefix_depth, prefix_recall


def shingles(text):
    w = (text or "").split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def brute(rows, threshold):
    """Per row: links, and the smallest id of its class."""
    sets = [shingles(t) for _, t in rows]
    links, root = collections.Counter(), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-9:
                links[i] += 1
                links[j] += 1
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [(r[0], links[i], rows[find(i)][0]) for i, r in enumerate(rows)]


@pytest.mark.parametrize("block", [7, 512])
def test_matches_brute_force(spark, block):
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(500)]
    texts = [[rng.choice(vocabulary) for _ in range(rng.randrange(0, 150))] for _ in range(120)]
    base = [rng.choice(vocabulary) for _ in range(130)]
    for k in range(60):  # one large group, some of it beyond the threshold
        t = list(base)
        for _ in range(k % 6):
            t[rng.randrange(len(t))] = rng.choice(vocabulary)
        texts.append(t)
    texts += [texts[3], texts[3], texts[5], ["a"], ["a"], [], []]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = sorted((r.doc_id, r.n_links, r.class_id) for r in
                 ngram_links(spark.createDataFrame(rows, "doc_id long, text string"), block=block).collect())
    assert got == brute(rows, 0.8)


def test_edges(spark):
    d = docs(spark)
    rows = ngram_links(d).collect()
    assert len(rows) == d.count()
    by = collections.defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    assert by[1][0].n_copies == 4 and by[1][0].n_links == 3 and by[1][0].copy_id == 1
    assert [r.class_id for r in by[2]] == [1, 1]
    for i in (3, 4, 5, 8, 12):
        assert (by[i][0].n_links, by[i][0].class_id) == (0, i)
    assert by[6][0].n_similar_texts == 1 and by[7][0].class_id == 6
    assert by[10][0].n_links == by[11][0].n_links == 1
    assert ngram_links(empty(spark)).count() == 0


def test_depth_and_components(spark):
    recall = prefix_recall(0.8, 32)
    d = prefix_depth()
    assert recall[d] >= 0.999 > recall[d + 1] and list(recall) == sorted(recall, reverse=True)
    # the trees share minima, so they find less than as many independent ones
    assert all(r <= 1 - (1 - 0.8 ** k) ** 32 + 0.002 for k, r in enumerate(recall))
    edges = spark.createDataFrame([(1, 2), (2, 3), (9, 3), (4, 5), (7, 7), (5, 4)] + [(100 + i, 101 + i) for i in range(40)], "a long, b long")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 9: 1, 4: 4, 5: 4, **{100 + i: 100 for i in range(41)}}


def test_tries_join_what_all_pairs_would():
    rng = np.random.default_rng(3)
    for trial in range(60):
        n = int(rng.integers(2, 40))
        below = np.sort(rng.integers(0, 3, (n, BELOW)).astype(np.uint64) @ (np.uint64(256) ** np.arange(BELOW, dtype=np.uint64)[::-1]))
        component = np.unique(rng.integers(0, n, n), return_inverse=True)[1]
        sketch = rng.integers(0, 2, (n, N_MINS)).astype(np.uint8)
        sketch[rng.integers(0, n, n // 2)] = sketch[0]
        block = rng.random(n) < 0.5 if trial % 2 else None
        label = joined_components(below, component, sketch, block)
        want = list(range(component.max() + 1))
        for _ in range(n):
            for i in range(n):
                for j in range(n):
                    if (sketch[i] == sketch[j]).mean() >= LEAST_ESTIMATE and (block is None or block[i] != block[j]):
                        want[component[i]] = want[component[j]] = min(want[component[i]], want[component[j]])
        assert label.tolist() == want
    assert common_levels(np.array([0x0102030405060708, 0x0102030405060708, 0x0102030405060709, 0x0202030405060709], np.uint64)).tolist() == [8, 7, 0]
