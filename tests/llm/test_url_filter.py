import pytest

from tessera.llm import url_filter as U
from tessera.llm.queries import URL_RULES

SCHEMA = "page_id long, url string, html string, rule string, verdict string"
CASES = [
    ("http://a.example.net/en/1", "example.net/en/", "allow"), ("http://a.example.net/de/1", "net/", "block"), ("https://net/x", "net/", "block"),
    ("https://x.net", None, "allow"), ("HTTP://A.EXAMPLE.COM/de/x?y#z", "example.com/de/", "block"), ("http://example.com/DE/", None, "allow"),
    ("http://notexample.com/de/", None, "allow"), ("http://b.org/fr/", "org/fr/", "allow"), ("http://b.org?/fr/", None, "allow"),
    ("no scheme.net/", None, "allow"), ("", None, "allow"), (None, None, "allow"), ("://", None, "allow"), ("a://b.net/://c.org/fr/", "net/", "block"),
    ("http://" + "a." * 3000 + "net/" + "p" * 50_000, "net/", "block"), ("http://É.net/", "net/", "block"), ("http://x.net\n/y", None, "allow"),
]


@pytest.mark.parametrize("limit", [U.MAX_INDEX_BYTES, 0])
def test_verdicts(spark, limit):
    rows = [(i, u, None, "r", "v") for i, (u, _, _) in enumerate(CASES)] + [(None, "http://q.net/", None, None, None)] * 2
    df = spark.createDataFrame(rows, SCHEMA)
    out = U.judge_urls(df, URL_RULES, max_index_bytes=limit)
    assert out.columns == ["page_id", "host", "path", "rule", "verdict"]
    got = {r.page_id: (r.rule, r.verdict) for r in out.collect() if r.page_id is not None}
    assert got == {i: (rule, verdict) for i, (_, rule, verdict) in enumerate(CASES)}
    assert out.where("page_id is null").count() == 2
    assert U.judge_urls(df.where("page_id > 999"), URL_RULES, max_index_bytes=limit).count() == 0


def test_parts(spark):
    df = spark.createDataFrame([("http://U@H.Com:80/a/b?c#d",), ("x://Ab",), ("x://Ab#/q",), (None,)], "url string")
    got = [tuple(r) for r in df.select(*U.host_and_path(df.url)).collect()]
    assert got == [("u@h.com:80", "/a/b"), ("ab", ""), ("ab", ""), ("", "")]


def test_index_confirms_strings(tmp_path, monkeypatch):
    # all digests collide: only the stored strings tell the rules apart
    monkeypatch.setattr(U.xxhash, "xxh64_intdigest", lambda _: 7)
    (tmp_path / "index").write_bytes(U.build_index([("a.org", "/x", "block"), ("b.org", "/", "allow"), ("org", "/", "block")]))
    index = U.DigestIndex(str(tmp_path / "index"))
    best = index.probe([b"w.a.org", b"b.org", b"c.org", b"d.com"], [b"/xy", b"/", b"/", b"/"])
    rule = [index.text[index.offsets[j]:index.offsets[j + 1]].tobytes() if j >= 0 else None for j in best]
    assert rule == [b"a.org/x", b"b.org/", b"org/", None]
    with pytest.raises(ValueError):
        U.build_index([("a", "/", "block"), ("a", "/", "allow")])
    with pytest.raises(ValueError):
        U.build_index([("a", "/", "maybe")])
