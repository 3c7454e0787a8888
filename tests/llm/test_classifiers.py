import numpy as np
import pytest
from edges import docs, empty, labels
from pyspark.sql import functions as F

from tessera.llm import quality, toxicity
from tessera.llm.docstats import FEATURES, document_features
from tessera.llm.labelled import held_out, training_texts
from tessera.llm.queries import _table
from tessera.llm.textarrays import utf8

SF01 = "/root/testdata/sf0.01"
SF1 = "/root/testdata/sf0.1"


def test_forest_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.uniform(size=(4000, 5))
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] > 0.3)).astype(float)
    model = quality.fit_forest(x[:3000], y[:3000])
    assert ((model.scores(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95
    assert quality.fit_forest(x[:0], y[:0]).scores(x).std() == 0


def test_features_are_finite_and_per_document():
    import pyarrow as pa
    texts = ["", "a", "A b\nA b", "é" * 50, "\n\n", "!!! ### !!!", "x " * 5000]
    x = document_features(*utf8(pa.array(texts)))
    assert x.shape == (len(texts), len(FEATURES)) and np.isfinite(x).all()
    for i, t in enumerate(texts):  # a document's row doesn't depend on its neighbours
        assert np.allclose(document_features(*utf8(pa.array([t]))), x[i])


def test_held_out_rows_and_labels(spark):
    import zlib
    rows = spark.range(200).select("id", held_out(F.col("id")).alias("out")).collect()
    assert all(r.out == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)
    d = spark.range(100).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    lab = labels(spark, [(i, i % 2, None) for i in range(100)] + [(1, 1, None), (None, 1, 1), (2, None, None)])
    sample = training_texts(d, lab, "quality", 30).collect()
    assert len(sample) == 30 and all(zlib.crc32(r.text.encode()) % 5 for r in sample)
    assert training_texts(d, lab, "toxic", 30).count() == 0


@pytest.mark.parametrize("scores, label, least", [(quality.quality_scores, "quality", 0.97), (toxicity.toxicity_scores, "toxic", 0.95)])
def test_held_out_accuracy(spark, scores, label, least):
    d, lab = _table(spark, SF1, "documents"), _table(spark, SF1, "labels")
    rows = scores(d, lab).join(lab, "doc_id").where("held_out").select(label, "predicted").toPandas()
    assert (rows[label] == rows.predicted).mean() >= least


@pytest.mark.parametrize("train, score", [(quality.train_quality, quality.score_quality), (toxicity.train_toxicity, toxicity.score_toxicity)])
def test_edges(spark, train, score):
    d = docs(spark)
    for lab in (labels(spark), labels(spark, [(1, 1, 1), (2, 1, 1)]), labels(spark, [(i, i % 2, i % 2) for i in range(13)])):
        model = train(d, lab)
        out = score(d, model)
        assert out.columns == [c for c in d.columns if c != "score"] + ["score", "predicted"]
        rows = out.collect()
        assert len(rows) == d.count() and all(0 <= r.score <= 1 for r in rows)
    model = train(empty(spark), labels(spark))
    assert score(empty(spark), model).count() == 0
    assert score(d, model).count() == d.count()


def test_label_model_finds_the_good_voters():
    rng = np.random.default_rng(3)
    y = rng.random(20_000) < 0.1
    rates = np.array([[0.01, 0.5]] * 4 + [[0.02, 0.6]] * 2 + [[0.05, 0.05]])
    votes = rng.random((20_000, 7)) < np.where(y[:, None], rates[:, 1], rates[:, 0])
    votes[:, 5] = votes[:, 4]  # a voter that repeats another
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = toxicity.fit_label_model(patterns, counts)
    assert ((model.posterior(votes) > 0.5) == y).mean() > 0.95
    assert model.weight[4] < 0.8 < model.weight[0]


def test_flattened_traversal_matches_a_plain_walk():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(800, 6))
    y = (x[:, 0] * x[:, 1] + x[:, 2] > 0).astype(float)
    model = quality.fit_forest(x, y, trees=25, depth=4)

    def leaf(node, row):
        while model.left[node] != node:
            node = model.left[node] if row[model.feature[node]] <= model.threshold[node] else model.right[node]
        return model.value[node]

    rows = np.concatenate([x[:150], rng.normal(size=(50, 6)) * 5, np.zeros((1, 6))])
    want = [model.base + sum(leaf(int(r), row) for r in model.roots) for row in rows]
    assert np.allclose(model.margins(rows), want)
    assert len({int(model.left[r] != r) for r in model.roots}) >= 1 and model.depth == 4


def test_pattern_voters_know_no_term():
    import pyarrow as pa
    cases = {"second_person": "You should keep your word to me", "capitals": "THIS WILL NEVER STAND here", "exclaims": "what!! no?! yes",
             "stretched": "that is sooooo bad", "signs_for_letters": "what a f**l he is"}
    names = list(toxicity.PATTERNS)
    fired = toxicity.pattern_votes(pa.array([*cases.values(), "A plain line of prose. It says nothing!", "", None, "a*b c$ 100% #tag"]))
    for k, name in enumerate(cases):
        assert fired[k, names.index(name)], name
    assert not fired[len(cases)].any() and not fired[len(cases) + 1:len(cases) + 3].any()
    # no pattern crosses from one text into the next
    assert not toxicity.pattern_votes(pa.array(["ooo", "ooo", "!", "!", "x*", "y"])).any()
