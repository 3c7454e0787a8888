"""The narrow parse: how large its generated code is, and that open and settled
texts side by side give what the whole conversion of each field gives."""

import datetime
import re

import pytest
from pyspark.sql import functions as F
from test_quick_values import OTHER, PLAIN

from paths import SF001
from tessera.functions import convert as cv
from tessera.functions.text import py_strip
from tessera.operators.ingest import ParseOptions, parse_lines
from tessera.operators.layout import Layout
from tessera.plans.queries import fw_join_counts, parsed_records

JIT_LIMIT = 8000  # bytes of a method; beyond, the JVM interprets it


def test_no_method_of_the_parse_is_too_large_for_the_jit(spark):
    frame = parsed_records(spark, SF001).frame
    code = spark._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < JIT_LIMIT, sizes


@pytest.mark.parametrize("flag", ["Y", "N"])
def test_columns_equal_the_whole_conversion(spark, flag):
    width, kinds = 44, (*sorted(PLAIN), "string")
    texts = [t.replace("\n", " ") for kind in sorted(PLAIN) for t in PLAIN[kind] + OTHER[kind]] + [" 5", "é", "\t7"]
    fields = [(f"{kind}_{n}", kind, width, flag if n == 0 else "N") for n in range(2) for kind in kinds]
    rows = [[texts[(k * 7 + i * step) % len(texts)] for i in range(len(fields))] for k in range(len(texts)) for step in (0, 1, 5)]
    lines = spark.createDataFrame([("".join(t.rjust(width) for t in row), str(i)) for i, row in enumerate(rows)], "value string, file_path string")
    got = {int(r["_path"]): r for r in parse_lines(lines, Layout.from_fields(fields), ParseOptions("T")).frame.collect()}
    for f, (name, kind, _, key) in enumerate(fields):
        alone = spark.createDataFrame([(i, row[f].rjust(width)) for i, row in enumerate(rows)], "i int, text string")
        whole, c = cv.convert_one(alone, py_strip(F.col("text")), kind, "_w_", ["*"], with_key=key == "Y")
        bad = F.lit(False) if c.bad is None else c.bad
        for r in whole.select("i", c.value.alias("value"), bad.alias("bad"), c.error_text.alias("error"), c.key_text.alias("key")).collect():
            parsed = got[r.i]
            assert str(parsed[f"_f{f}"]) == str(r.value), (name, rows[r.i][f])
            errors = [e.column_value for e in parsed["_errors"] or [] if e is not None and e.column_name == name]
            assert errors == ([r.error] if r.bad else []), (name, rows[r.i][f])
            if key == "Y":
                assert f"{name}={r.key}" in parsed["_key"], (name, rows[r.i][f])


def test_settled_records_reach_no_list_function_and_no_regex_of_the_whole_record(spark):
    frame = parsed_records(spark, SF001).frame
    plan = spark._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "simple")
    assert "RLIKE ^[ -~]*$" not in plan
    done = re.findall(r"(\S*\S) AS _list\d+_done", plan.replace("\n", " "))
    assert done
    for k in range(len(done)):
        assert re.search(rf"CASE WHEN isnotnull\(_list{k}_open#\d+\) THEN transform\(", plan), k


def test_white_space_at_the_ends_of_texts(spark):
    width, texts = 6, ["a\x1f", "\x0bb", "\x7f", "\x00c", "\x1c12\x1d", "\t7", "7\r", "\u3000x\xa0", "\xa05", "é 5", "+5", "", "\x1f \x1f", "~", "!"]
    fields = [("S", "string", width, "Y"), ("N", "numeric", width, "N"), ("R", "rate", width, "N")]
    rows = [(a, b, texts[(i + j) % len(texts)]) for i, a in enumerate(texts) for j, b in enumerate(texts)]
    lines = spark.createDataFrame([("".join(t.center(width) for t in row), str(i)) for i, row in enumerate(rows)], "value string, file_path string")
    got = {int(r["_path"]): r for r in parse_lines(lines, Layout.from_fields(fields), ParseOptions("T")).frame.collect()}
    whole = spark.createDataFrame([(t,) for t in texts], "text string")
    want = {}
    for _, kind, _, _ in fields:
        frame, c = cv.convert_one(whole, py_strip(F.col("text")), kind, "_w_", ["*"])
        for r in frame.select("text", c.value.alias("value"), (F.lit(False) if c.bad is None else c.bad).alias("bad")).collect():
            want[kind, r.text] = (r.value, r.bad)
    for i, row in enumerate(rows):
        for f, (name, kind, _, _) in enumerate(fields):
            bad = any(e is not None and e.column_name == name for e in got[i]["_errors"] or [])
            assert (got[i][f"_f{f}"], bad) == want[kind, row[f]], (kind, row[f])
    assert got[0]["_key"] == "S=a"


def test_days_of_the_calendar(spark):
    texts = [f"{y}{m:02}{d:02}" for y in ("0000", "0001", "1900", "2000", "2023", "2024", "9999") for m in (0, 1, 2, 4, 12, 13, 99) for d in (0, 1, 28, 29, 30, 31, 32, 99)]

    def real(t: str) -> bool:
        try:
            return bool(datetime.date(int(t[:4]), int(t[4:6]), int(t[6:])))
        except ValueError:
            return False

    for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", cv.is_day(F.col("t")).alias("found")).collect():
        assert r.found == real(r.t), r.t


def test_counts_are_aggregated_once(spark):
    read = fw_join_counts(spark, SF001).inputFiles()
    assert read and all("file-counts" in f for f in read), read
