"""Templates and keyed permutations of masked values."""

import re

import pytest
from pyspark.sql import functions as F

from tessera.functions import mask as gen
from tessera.functions.permute import permuted, radices, walks
from tessera.functions.templates import parse_template
from tessera.operators.mask import keyed_mask

SALT = "s"


def filled(spark, template, n=300):
    h = gen.key_hash("x", F.col("id").cast("string"))
    return [r.v for r in spark.range(n).select(gen.template(h, template).alias("v")).collect()]


@pytest.mark.parametrize("template,pattern", [
    ("+61 4## ### ###", r"\+61 4\d\d \d{3} \d{3}"), ("@@-??", r"[A-Z]{2}-[a-z]{2}"), (r"\#\@\?\[\{\\", r"#@\?\[\{\\"),
    ("[a|bc|d e]", "a|bc|d e"), ("[7-12]", r"[789]|1[012]"), ("{city}!", r"[A-Z][A-Za-z ]+!"), ("", ""), ("plain", "plain"),
    ("################", r"\d{16}"),
])
def test_values_have_the_form_of_the_template(spark, template, pattern):
    values = filled(spark, template)
    assert all(re.fullmatch(pattern, v) for v in values)
    assert filled(spark, template) == values  # the same key, the same value
    if template.count("#") > 8:
        assert len(set(values)) > 250


def test_every_choice_is_drawn(spark):
    assert set(filled(spark, "[7-12]")) == {"7", "8", "9", "10", "11", "12"}
    assert set(filled(spark, "[a|bc|d e]")) == {"a", "bc", "d e"}


@pytest.mark.parametrize("bad", ["[a", "a]", "{x", "x}", "[]", "[a||b]", "[9-3]", "\\"])
def test_bad_templates(bad):
    with pytest.raises(ValueError):
        parse_template(bad)


@pytest.mark.parametrize("spec", [
    {"Function": "template"}, {"Function": "template", "MockKwargs": {"template": "{nothing}"}},
    {"Function": "phone_number", "MockKwargs": {"mask": "["}}, {"Function": "email", "MockKwargs": {"domains": []}},
    {"Function": "template", "MockKwargs": {"template": "{distinct_number}"}}, {"Function": "address", "MockKwargs": {"x": 1}},
])
def test_specs_are_checked_before_anything_is_built(spark, spec):
    df = spark.createDataFrame([("a",)], "v string")
    with pytest.raises(ValueError):
        keyed_mask(df, {"v": {"DataProvider": [{"ValueType": "All", **spec}]}}, salt=SALT)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 10, 100, 1000, 4097])
def test_small_ranges_are_permuted(spark, size):
    height, width = radices(size)
    assert size <= height * width < size + width
    got = {}
    for key in ("k", "other"):
        rows = spark.range(-2, size + 2).select("id", permuted(F.col("id"), size, key).alias("p")).collect()
        got[key] = [r.p for r in rows if 0 <= r.id < size]
        assert {r.p for r in rows if not 0 <= r.id < size} == {None}
        assert len(set(got[key])) == size
        if walks(size) > height * width - size:  # enough passes for any number
            assert sorted(got[key]) == list(range(size))
    assert size < 7 or got["k"] != got["other"]


def test_no_two_of_a_million_and_a_half_numbers_meet(spark):
    numbers = spark.range(0, 1_500_000, 1, 8)
    masked = numbers.select(permuted(F.col("id") * 131_071, 199_999_999_900_001, "key").alias("p"))
    r = masked.agg(F.count("p").alias("n"), F.count_distinct("p").alias("d"), F.min("p").alias("lo"), F.max("p").alias("hi")).first()
    assert (r.n, r.d) == (1_500_000, 1_500_000)
    assert 0 <= r.lo and r.hi < 199_999_999_900_001


def test_distinct_numbers_in_a_table(spark):
    spec = {"v": {"DataProvider": [{"ValueType": "All", "Function": "distinct_number", "MockKwargs": {"start": 1000, "end": 1999}}]}}
    df = spark.createDataFrame([(str(k),) for k in range(1000)] + [("",), (None,), ("x1",), ("5000",), ("12345678901234567890",)], "v string").coalesce(1)
    rows = [r.v for r in keyed_mask(df, spec, salt=SALT).collect()]
    assert sorted(map(int, rows[:1000])) == list(range(1000, 2000))
    assert rows[1000:] == ["", None, None, None, None]
    account = spark.createDataFrame([("1000",), ("1999",)], "v string")
    assert len({r.v for r in keyed_mask(account, spec, salt=SALT).collect()}) == 2
