"""The quick form of the conversion (wide layouts) against the whole one."""

import pytest
from pyspark.sql import functions as F

from tessera.functions import convert as cv
from tessera.operators.ingest import ParseOptions, parse_lines
from tessera.operators.layout import Layout

PLAIN = {
    "numeric": ["", "0", "000", "+00012", "-5", "999999999999999999"],
    "amount": ["", "0", "00012.50", "+7", "-0.5", "99999999999999999999.123456789012345678"],
    "rate": ["5%", "0.05", "+5", "7.", "00.1%"],
    "date": ["", "00000000", "20240229", "15821015", "15821014", "00010101"],
}
OTHER = {
    "numeric": ["12A", "+", "++5", "+-5", "1_000", "9999999999999999999", "5\n", "1 2"],
    "amount": ["12,345.00", ".5", "5.", "1e3", "1_0.5", "100000000000000000000", "0.1234567890123456789", "5\n"],
    "rate": ["", "%", "x%", "abc", "%5", "5%%", "1e3", "nan", "-inf", "5\n"],
    "date": ["20230229", "20231345", "15000231", "00000101", "2024115", "abc", "20240101\n"],
}


@pytest.mark.parametrize("kind", sorted(PLAIN))
def test_quick_value_equals_the_whole_conversion(spark, kind):
    rows = spark.createDataFrame([(t, True) for t in PLAIN[kind]] + [(t, False) for t in OTHER[kind]], "text string, plain boolean")
    whole, c = cv.convert_one(rows, F.col("text"), kind, "_w_", ["*"])
    for r in whole.select("text", "plain", cv.quick_value(kind, F.col("text")).alias("quick"), c.value.alias("value"), c.bad.alias("bad")).collect():
        assert (r.quick is not None) or not r.plain, r
        assert r.quick is None or (r.quick == r.value and not r.bad), r


def test_lists_equal_columns_on_plain_and_other_texts(spark):
    width = 44
    fields = [(f"{kind}-{n}", kind.upper(), width, "Y" if n == 0 else "N") for n in range(2) for kind in (*sorted(PLAIN), "string")]
    texts = [t.replace("\n", " ") for kind in sorted(PLAIN) for t in PLAIN[kind] + OTHER[kind]] + [" 5", "é", "\t7"]
    lines = ["".join(texts[(k * 7 + i * step) % len(texts)].rjust(width) for i in range(len(fields))) for k in range(len(texts)) for step in (0, 1, 5)]
    df = spark.createDataFrame([(v, "/in/LI.AU_A.TXT") for v in [*lines, "short"]], "value string, file_path string")
    wide, flat = (parse_lines(df, Layout.from_fields(fields), ParseOptions("T", wide_from=n)) for n in (1, 10_000))
    for output in ("typed", "exceptions", "width_rejects", "file_counts"):
        a, b = (sorted(map(str, getattr(p, output)().collect())) for p in (wide, flat))
        assert a == b, output
