import random

import pyarrow as pa
import pytest
import sentencepiece
from edges import docs, empty

from tessera.llm import sentencepieces as S
from tessera.llm.queries import PIECE_MODEL
from tessera.llm.textarrays import utf8


@pytest.fixture(scope="module")
def model():
    return S.read_model(PIECE_MODEL)


@pytest.fixture(scope="module")
def library(model):
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def test_ids_and_texts_equal_the_library(model, library):
    rng = random.Random(3)
    parts = ["a", "the", "in", "ing", " ", "  ", "er", "▁", "\n", "\t", "é", "ü", "ß", "日本", "😀", "π", "x", "th", ".", ",", "0", "\u200b"]
    texts = ["", " ", "  Hello  world\n foo ", " " * 37 + "x" + " " * 20, "x" * 3000, "the" * 2000, "ﬁ ½\x00c", "\n\n"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randrange(80))) for _ in range(1500)]
    encoder, decoder = S._codec(model)
    ids, offsets = encoder.encode(*utf8(pa.array(texts)))
    for k, text in enumerate(texts):
        assert ids[offsets[k]:offsets[k + 1]].tolist() == library.encode(text), text
    assert decoder.decode(ids.astype(int), offsets) == [library.decode(library.encode(t)) for t in texts]


def test_encode_and_decode_frames(spark, model, library):
    d = docs(spark)
    encoded = S.encode_pieces(d, model)
    assert encoded.columns == [c for c in d.columns if c != "ids"] + ["ids"]
    rows = S.decode_pieces(encoded, model).collect()
    assert len(rows) == d.count()
    for r in rows:
        assert r.decoded == r.text
        assert r.ids == (None if r.text is None else library.encode(r.text))
    assert S.encode_pieces(empty(spark), model).count() == 0
    with pytest.raises(Exception, match="not in the piece table"):
        S.decode_pieces(spark.createDataFrame([([99_999_999],)], "ids array<int>"), model).collect()


@pytest.mark.parametrize("kept", [1, 40, 1 << 19])
def test_words_are_encoded_once_and_rare_ones_forgotten(model, library, monkeypatch, kept):
    monkeypatch.setattr(S, "KEPT_WORDS", kept)
    encoder, through = S.Encoder(S.PieceTable(model)), []
    whole = encoder._encode_words
    monkeypatch.setattr(encoder, "_encode_words", lambda points, span, start, end, strange: (
        through.append(len(start)), whole(points, span, start, end, strange))[1])
    rng = random.Random(5)
    common = ["the", "of", "and  ", "é", "日本", " x"]
    for _ in range(30):
        texts = [" ".join([*rng.choices(common, k=20), f"w{rng.randrange(10**9)}"]) for _ in range(5)]
        ids, offsets = encoder.encode(*utf8(pa.array([*texts, ""])))
        assert [ids[lo:hi].tolist() for lo, hi in zip(offsets, offsets[1:], strict=False)] == [library.encode(t) for t in [*texts, ""]]
        assert len(encoder.words.hashes) <= kept + 40
    if kept > 1:
        assert sum(through) < 30 * 10


def test_a_task_leaves_no_words_in_the_worker(model, monkeypatch):
    class Rows:  # hands the task over instead of running it
        columns, schema = ["text"], S.T.StructType([S.T.StructField("text", S.T.StringType())])

        def mapInArrow(self, task, schema):
            return task

    monkeypatch.setattr(S, "_with_column", lambda df, name, kind: (df, df.schema))
    monkeypatch.setattr(S, "_ready", {})
    encoder, _ = S._codec(model)
    rows = S.encode_pieces(Rows(), model)(iter([pa.RecordBatch.from_pydict({"text": ["one two", None]})]))
    assert next(rows).num_rows == 2 and len(encoder.words.hashes) == 2
    assert list(rows) == [] and len(encoder.words.hashes) == 0
