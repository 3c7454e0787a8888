import collections

from edges import docs, empty
from pyspark.sql import functions as F

from tessera.llm.line_dedup import dedup_lines


def brute(rows, min_sites):
    """``rows`` of (id, text, site): texts without repeated boilerplate lines."""
    sites, first = collections.defaultdict(set), {}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    for i, text, site in order:
        for pos, line in enumerate((text or "").split("\n")):
            key = line.strip(" ")
            if key:
                sites[key].add(site or "")
                first.setdefault(key, (i, text, pos))
    out = []
    for i, text, _ in rows:
        if text is None:
            out.append((i, None, 0, 0))
            continue
        lines = text.split("\n")
        kept = [x for pos, x in enumerate(lines)
                if len(sites.get(x.strip(" "), ())) < min_sites or first[x.strip(" ")] == (i, text, pos)]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def test_matches_brute_force(spark):
    rows = [(i, "\n".join(["common", f"own {i}", " common ", "rare" if i < 3 else f"r{i}", "", "twice" if i % 2 else "x"]), f"s{i % 7}")
            for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for sites in (2, 4, 7, 8):
        got = [tuple(r) for r in dedup_lines(df, min_sites=sites).select("doc_id", "text", "n_lines", "n_removed").collect()]
        assert sorted(got, key=repr) == brute(rows, sites)


def test_edges(spark):
    d = docs(spark)
    out = dedup_lines(d, min_sites=2)
    assert out.columns == [c for c in d.columns if c != "n_lines"] + ["n_lines", "n_removed"]
    rows = out.collect()
    assert len(rows) == d.count()
    by = collections.defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    assert by[3][0].text is None and by[4][0].text == "" and by[5][0].text == " \n\t \n"
    assert [r.text for r in by[1]] == [""] and by[1][0].n_removed == 2
    assert sorted(r.text or "" for r in by[None])[1].startswith("One line")  # the first copy stays whole
    assert [r.text for r in by[2]] == ["", ""]
    assert dedup_lines(empty(spark)).count() == 0


def test_near_threshold_lines_are_counted_exactly(spark):
    rows = [(i, f"line {k}", f"site {i}") for k in (95, 99, 100, 101, 105) for i in range(k)]
    df = spark.createDataFrame([(n, *r[1:]) for n, r in enumerate(rows)], "doc_id long, text string, source string")
    out = dedup_lines(df, min_sites=100, margin=0.3)
    left = {r.text: r.n for r in out.groupBy("text").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert left["line 95"] == 95 and left["line 99"] == 99
    assert left["line 100"] == left["line 101"] == left["line 105"] == 1
