"""Landed source files: whole rows, no sort by folder, settings left as they were."""

from collections import Counter

from paths import SF001
from tessera.plans import fixtures

WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def _records(spark):
    return Counter((r.file_path.split("/")[-1], r.value) for r in fixtures.lineitem_records(spark, SF001).collect())


def test_sources_land_whole(spark, tmp_dir):
    before = spark.conf.get(WRITERS)
    fixtures.land_sources(spark, fixtures.lineitem_records(spark, SF001), f"{tmp_dir}/in")
    assert spark.conf.get(WRITERS) == before
    assert Counter((r.src, r.value) for r in spark.read.text(f"{tmp_dir}/in").collect()) == _records(spark)


def test_named_files_and_their_counts(spark, tmp_dir):
    fixtures.land_named(spark, SF001, tmp_dir)
    records, files = _records(spark), Counter()
    for (name, _), n in records.items():
        files[name] += n
    for name, n in files.items():
        assert spark.read.text(f"{tmp_dir}/in/{name}").count() == n
    lines = sorted([*(f"{name}: {n}" for name, n in files.items()), f"{fixtures.EMPTY_FILE}: 0"])
    assert [r.value for r in spark.read.text(f"{tmp_dir}/marker").collect()] == lines


def test_texts_of_amounts_are_those_of_the_formatter(spark):
    odd = [0.0, -0.0, 0.004, 0.005, 0.01, 0.015, 0.125, 0.29, 1.005, 1.115, 2.675, 4.35, 0.5, 1.5, 2.5, 0.49999999999999994, 6.999999999999999, 7.000000000000001,
           901.0, 104949.5, 999999999999.99, 1e12, 1e15, 1e23, 9.3e18, 1e300, -5.25, -0.001, float("nan"), float("inf"), float("-inf"), None]
    rows = spark.createDataFrame([(x,) for x in odd + [n / 100 for n in range(0, 300_000, 7)]], "x double")
    both = rows.selectExpr("x", *(f"{made('x')} as got_{k}" for k, made in enumerate((fixtures.two_places, fixtures.no_places))),
                           "format_string('%.2f', x) as want_0", "format_string('%.0f', x) as want_1")
    assert [r for r in both.collect() if (r.got_0, r.got_1) != (r.want_0, r.want_1)] == []
