"""The pipeline's stages, each for itself on the edges, and all together
against plain code."""

import os
import random
import re

import pytest
import sentencepiece
from edges import docs, empty
from pyspark.sql import functions as F

import corpus_pipeline as P
from tessera.llm import quality
from tessera.llm.queries import PIECE_MODEL
from test_decontaminate import distance
from test_ngram_join import brute as brute_links

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, uid long, words string, row int, place int"


def tables(spark, path, items=("no such text stands in any of the documents here at all",), labelled=()):
    spark.createDataFrame([(k, t) for k, t in enumerate(items)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame(list(labelled), "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def same(rows):
    return sorted(map(repr, rows))


@pytest.mark.parametrize("name,stage", P.STAGES)
def test_every_stage_keeps_columns_and_takes_all_edges(spark, tmp_dir, name, stage):
    d = docs(spark)
    sf = tables(spark, tmp_dir, ["one line of text that several DOCUMENTS share with each other", None, ""],
                [(i, 1, 0) for i in range(12)])
    out = stage(spark, d, sf)
    last = name == "sentencepiece"
    assert out.columns == [c for c in d.columns if not last or c != "ids"] + (["ids", "n_tokens"] if last else [])
    rows, given = out.collect(), d.collect()
    assert stage(spark, empty(spark), sf).count() == 0
    if name in ("quality", "near_duplicates", "decontamination"):
        assert set(same(rows)) <= set(same(given))
    if name == "quality":  # all labels are 1
        assert same(rows) == same(given)
    if name == "line_dedup":  # one source holds a line at most twice
        assert same((*r[:4], *r[5:]) for r in rows) == same((*r[:4], *r[5:]) for r in given)
        assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in rows)
    if name == "near_duplicates":
        assert sorted(r.doc_id or 0 for r in rows) == [0, 0, 1, 3, 4, 5, 6, 8, 9, 9, 10, 12]
    if name == "decontamination":
        assert same(rows) == same(r for r in given if "share with each other" not in (r.text or ""))
    if last:
        sp = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
        assert sorted((r.doc_id or 0, r.n_tokens) for r in rows) == sorted((r.doc_id or 0, len(sp.encode(r.text)) if r.text else 0) for r in given)
        assert all((r.ids is None) == (r.text is None) for r in rows)


def test_clashing_columns_come_out_as_they_went_in(spark, tmp_dir):
    d = docs(spark).select("doc_id", "text", "lang", "source", "n_chars", "score", F.lit(5).cast("long").alias("uid"), F.lit("w").alias("words"),
                           F.lit(7).alias("row"), F.lit(9).alias("place"), F.lit(1).alias("predicted"), F.lit(2).alias("class_id"), F.lit("h").alias("hits"))
    sf = tables(spark, tmp_dir, labelled=[(i, 1, 0) for i in range(12)])
    for _, stage in P.STAGES:
        rows = stage(spark, d, sf).collect()
        assert rows and {(r.score, r.uid, r.words, r.row, r.place, r.predicted, r.class_id, r.hits) for r in rows} == {(0.5, 5, "w", 7, 9, 1, 2, "h")}


def corpus(rng):
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8)))
    line = lambda n=12: " ".join(word() for _ in range(n))
    boiler = [line(6) for _ in range(3)]
    item = " ".join(word() for _ in range(30))
    bases = ["\n".join(line() for _ in range(6)) for _ in range(40)]
    rows = []
    for i in range(240):
        text = rng.choice(bases) if i % 4 == 0 else "\n".join(line() for _ in range(rng.randrange(1, 8)))
        if i % 9 == 0:
            text = text.replace(" ", "%%% ")  # junk
        if i % 5 == 0:
            text += "\n" + rng.choice(boiler)
        if i % 16 == 3:
            text += "\n" + item
        rows.append((i, text, "en", f"s{i % 12}", len(text)))
    rows += [(300, None, "en", None, None), (301, "", "en", "s1", 0), (None, bases[0], "en", "s2", 1), (302, "x " * 9000, "en", "s3", 18000)]
    return rows, item


def plain(rows, kept_by_quality, item):
    """The stages in plain code; ``kept_by_quality`` is the classifier's verdict by text."""
    rows = [r for r in rows if kept_by_quality[r[1]]]
    # lines on ten sources or more: the first occurrence of the corpus stays
    sites, first = {}, {}
    for i, text, _, source, _ in rows:
        for pos, x in enumerate((text or "").split("\n")):
            if x.strip(" "):
                sites.setdefault(x.strip(" "), set()).add(source or "")
                first[x.strip(" ")] = min(first.get(x.strip(" "), (True, 10**9, 0)), (i is not None, i or 0, pos))
    out = []
    for i, text, lang, source, _ in rows:
        if text is not None:
            text = "\n".join(x for pos, x in enumerate(text.split("\n"))
                             if len(sites.get(x.strip(" "), ())) < 10 or first[x.strip(" ")] == (i is not None, i or 0, pos))
        out.append((i, text, lang, source, None if text is None else len(text)))
    links = brute_links([(r[0], r[1]) for r in out if r[0] is not None], 0.8)
    gone = {i for i, _, least in links if least < i}
    out = [r for r in out if r[0] not in gone]
    words = lambda t: [w for w in (re.sub(r"^[^a-z0-9]+|[^a-z0-9]+$", "", x.lower()) for x in (t or "").split()) if w]
    out = [r for r in out if distance(item.split(), words(r[1])) > 6]
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    return [(*r, None if r[1] is None else sp.encode(r[1]), len(sp.encode(r[1])) if r[1] else 0) for r in out]


def test_the_whole_pipeline_matches_plain_code(spark, tmp_dir):
    rows, item = corpus(random.Random(6))
    labelled = [(r[0], int("%%%" not in (r[1] or "")), 0) for r in rows if r[0] is not None]
    sf = tables(spark, tmp_dir, [item], labelled)
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    d.repartition(5).write.parquet(f"{sf}/documents.parquet")
    read = spark.read.parquet(f"{sf}/documents.parquet")
    verdicts = quality.score_quality(read, quality.train_quality(read, spark.read.parquet(f"{sf}/labels.parquet"))).collect()
    kept = {r.text: r.predicted == 1 for r in verdicts}
    assert {r[1] for r in rows if "%%%" in (r[1] or "")} == {t for t, k in kept.items() if not k and "%%%" in (t or "")}
    got = [tuple(list(v) if isinstance(v, list) else v for v in r) for r in P.run(spark, sf).collect()]
    assert same(got) == same(plain(rows, kept, item))


def test_stage_tables_are_removed(spark, tmp_dir, monkeypatch):
    rows, item = corpus(random.Random(1))
    sf = tables(spark, tmp_dir, [item], [(r[0], int(r[0] % 9 > 0), 0) for r in rows if r[0] is not None])
    spark.createDataFrame(rows[:60], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{sf}/documents.parquet")
    root = f"{spark.conf.get('spark.checkpoint.dir')}/tessera-{spark.sparkContext.applicationId}"

    def folders(name):
        return sorted(os.listdir(f"{root}/{name}")) if os.path.isdir(f"{root}/{name}") else []

    names = [name for name, _ in P.STAGES]

    def here():
        return {name: folders(f"pipeline/{name}") for name in names} | {"scratch": folders("scratch")}

    before = here()
    assert P.run(spark, sf).count() > 0
    after = here()
    assert {k for k in after if after[k] != before[k]} == {"sentencepiece"}  # the result

    def failing(spark, docs, sf_dir):
        raise RuntimeError("lost")

    monkeypatch.setattr(P, "STAGES", [*P.STAGES[:3], ("decontamination", failing)])
    with pytest.raises(RuntimeError):
        P.run(spark, sf)
    assert here() == after
