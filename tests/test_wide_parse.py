"""The wide parse: what settles its texts, and that it gives what the narrow one gives."""

import datetime
import re

import pytest
from pyspark.sql import functions as F
from test_quick_values import OTHER, PLAIN

from paths import SF001
from tessera.functions import convert as cv
from tessera.operators.ingest import ParseOptions, parse_lines
from tessera.operators.layout import Layout
from tessera.plans.queries import fw_wide_exceptions, fw_wide_rows

JIT_LIMIT = 8000  # bytes of a method; beyond, the JVM interprets it


def explained(df, mode: str) -> str:
    spark, key = df.sparkSession, "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(key)
    spark.conf.set(key, "1000")
    try:
        return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)
    finally:
        spark.conf.set(key, before)


def test_values_of_plain_and_foreign_texts_reach_no_list_function(spark):
    plan = explained(fw_wide_rows(spark, SF001), "simple")
    assert "exists(" not in plan and "filter(" not in plan
    assert set(re.findall(r"CASE WHEN \(\(_good#\d+ AND NOT _list(\d+)_settled", plan)) == set("01234")  # keys, dates, numbers, amounts, rates


def test_the_length_of_a_record_is_counted_once(spark):
    lines = spark.createDataFrame([("5" * 200, "/in/LI.AU_A.TXT")], "value string, file_path string")
    layout = Layout.from_fields([(f"N{k}", "NUMERIC", 5, "N") for k in range(40)])
    plan = explained(parse_lines(lines, layout, ParseOptions("T")).typed(), "simple")
    assert len(re.findall(r"(?<!_)length\(value#", plan)) == 1


@pytest.mark.parametrize("query", [fw_wide_rows, fw_wide_exceptions])
def test_no_method_is_too_large_for_the_jit(spark, query):
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", explained(query(spark, SF001), "codegen"))]
    assert sizes and max(sizes) < JIT_LIMIT, sizes


MORE = ["A", "~", "-", "+", "_", "1_0", "5e2", "INF", "-nan", "i", "%", "1%2", "x%", "2 4", "12:5", "\x0112", "٠", "１", "\xa05", "1\x1f", "5\n6", "\n"]


@pytest.mark.parametrize("kind", sorted(PLAIN))
def test_foreign_characters_make_the_default(spark, kind):
    texts = sorted({t for k in PLAIN for t in PLAIN[k] + OTHER[k]} | set(MORE))
    whole, c = cv.convert_one(spark.createDataFrame([(t,) for t in texts], "text string"), F.col("text"), kind, "_w_", ["*"])
    text = F.col("text")
    rows = whole.select("text", cv.has_default(kind, text).alias("default"), text.rlike(cv.QUICK_RE[kind]).alias("plain"),
                        cv.all_plain(kind, cv.joined([text, F.lit("5" * 8)]), 2).alias("all_plain"),
                        cv.all_settled(kind, cv.joined([text, F.lit("5" * 8), F.lit("#")]), 3).alias("all_settled"),
                        c.value.alias("value"), cv.default_value(kind).alias("is"), c.bad.alias("bad")).collect()
    assert any(r.default for r in rows) and any(r.all_plain for r in rows)
    for r in rows:
        # an empty rate is an error, other empty texts are none
        assert not r.default or (r.value == r["is"] and r.bad), r
        assert r.all_plain == (r.plain or (r.text == "" and kind != "rate")), r
        assert r.all_settled == (r.plain or r.default or r.text == ""), r


def test_day_numbers(spark):
    texts = [f"{y}{m:02}{d:02}" for y in ("0000", "0001", "1582", "1900", "2000", "2023", "2024", "9999") for m in (0, 1, 2, 4, 10, 12, 13, 99)
             for d in (0, 1, 14, 15, 28, 29, 30, 31, 32, 99)] + ["", "2024115", "+2024115", "abc"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", cv.day_number(F.col("t"), F.lit(False)).alias("n"))
    for r in df.select("t", "n", cv.number_date(F.col("n")).alias("date")).collect():
        try:
            day = datetime.date(int(r.t[:4]), int(r.t[4:6]), int(r.t[6:]))
        except ValueError:
            day = cv.DEFAULT_DATE
        assert (r.n is not None) == (len(r.t) == 8 and r.t.isdigit()), r
        assert r.n is None or r.date == (day if day >= cv.GREGORIAN_START else cv.DEFAULT_DATE), r


@pytest.mark.parametrize("flag,pattern", [("Y", "YYYYMMDD"), ("N", "DD/MM/YYYY")])
def test_wide_equals_narrow(spark, flag, pattern):
    width, kinds = 24, (*sorted(PLAIN), "string")
    texts = sorted({t for k in PLAIN for t in PLAIN[k] + OTHER[k] if len(t) <= width} | set(MORE) | {"5/11/2024", "é", "\t7", " 5", "\U0001f600 1"})
    fields = [(f"{kind}_{n}", kind, width, flag if n == 0 else "N") for n in range(2) for kind in kinds]
    rows = [[texts[(k * 7 + i * step) % len(texts)] for i in range(len(fields))] for k in range(len(texts)) for step in (0, 1, 5)]
    lines = [("".join(t.rjust(width) if i % 2 else t.ljust(width) for i, t in enumerate(row)), f"/in/LI.AU_{n % 3}.TXT") for n, row in enumerate(rows)]
    lines += [("é" * 60, "/in/X"), ("é" * (width * 5), "/in/X"), ("", "/in/X")]
    df = spark.createDataFrame(lines, "value string, file_path string")
    wide, narrow = (parse_lines(df, Layout.from_fields(fields), ParseOptions("T", pattern, wide_from=n)) for n in (1, 10_000))
    for output in ("typed", "exceptions", "width_rejects", "file_counts"):
        a, b = (sorted(map(str, getattr(p, output)().collect())) for p in (wide, narrow))
        assert a == b, output


def test_a_layout_of_more_fields_than_a_stage_may_have(spark):
    fields = [(f"{kind}_{n}", kind, 10, "Y" if n == 0 and kind == "string" else "N") for n in range(24) for kind in (*sorted(PLAIN), "string")]
    texts = ["1", "x", "20240131", "20240230", "", "5%", "1.25", "1_0"]
    lines = [("".join(texts[(i * (n + 1) + n) % 8].ljust(10) for i in range(len(fields))), "/in/A") for n in range(16)]
    df = spark.createDataFrame(lines, "value string, file_path string")
    wide, narrow = (parse_lines(df, Layout.from_fields(fields), ParseOptions("T", wide_from=n)) for n in (40, 10_000))
    for output in ("typed", "exceptions"):
        a, b = (sorted(map(str, getattr(p, output)().collect())) for p in (wide, narrow))
        assert a == b, output
