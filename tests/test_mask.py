"""Masking by type (M1-M15, V1-V3) and by key (M16-M19), configs and delimited I/O."""

import csv
import json
import os

import pytest
from pyspark.sql import functions as F

from paths import SF001
from tessera.functions import vocab
from tessera.operators.mask import TYPES, apply_mask_config, keyed_mask, validate_config
from tessera.plans.fixtures import customer_contacts
from tessera.plans.mask_job import mask_pipe_files, run_keyed_mask_dir, run_mask_job
from tessera.plans.queries import MASK_CONFIG, MASK_SPEC
from tessera.sinks.publish import redated_name
from tessera.sources.config import load_mask_config
from tessera.sources.delimited import read_delimited, read_pipe_directory


@pytest.fixture(scope="module")
def cust(spark):
    return customer_contacts(spark, SF001).cache()


def test_validation(cust):
    cols = cust.columns
    validate_config(MASK_CONFIG, cols)
    with pytest.raises(RuntimeError, match="lacks"):
        validate_config({"nope": {"type": "city"}}, cols)
    with pytest.raises(RuntimeError, match="unknown mask type"):
        validate_config({"segment": {"type": "nope"}}, cols)
    with pytest.raises(RuntimeError, match="lacks"):
        validate_config({"full_name": {"type": "firstname", "meta": {"gender_column_name": "sex"}}}, cols)


@pytest.mark.parametrize("type_name", sorted(TYPES))
def test_every_type_replaces_every_row(cust, type_name):
    meta = {"firstname": {"gender_column_name": "gender"}, "lastname": {"gender_column_name": "gender"},
            "contact_details": {"contact_type_column_name": "contact_type"}}.get(type_name)
    cfg = {"type": type_name, **({"meta": meta} if meta else {})}
    out = apply_mask_config(cust, {"full_name": cfg}, salt="s")
    assert out.columns == cust.columns
    joined = out.select("cust_id", F.col("full_name").alias("m")).join(
        cust.select("cust_id", "full_name", "contact_type"), "cust_id")
    rows = joined.collect()
    assert len(rows) == cust.count()
    if type_name == "contact_details":
        for r in rows:
            t = (r.contact_type or "").lower()
            assert (r.m is None) == (r.contact_type is None or ("email" not in t and "phone" not in t))
            if r.m is not None and "email" in t:
                assert "@" in r.m
    else:
        assert all(r.m is not None and r.m != r.full_name for r in rows)


def test_shapes(cust):
    out = apply_mask_config(cust, {
        "cust_id": {"type": "account_number"}, "segment": {"type": "drivers_license"},
        "contact_type": {"type": "zip_code"}, "contact_value": {"type": "date_of_birth"}}, salt="s").collect()
    for r in out:
        assert 1000000000100000 <= int(r.cust_id) <= 1200000000000000
        assert r.segment[:2].isalpha() and r.segment[:2].isupper() and 1000 <= int(r.segment[2:]) <= 9999
        assert len(r.contact_type) == 4 and r.contact_type.isdigit()
        assert "2000-01-01 00:00:00" <= r.contact_value <= "2005-12-31 00:00:00"


def test_gender_rule(cust):
    out = apply_mask_config(cust, {"full_name": {"type": "firstname", "meta": {"gender_column_name": "gender"}}}, salt="s")
    for r in out.collect():
        if r.gender == "F":
            assert r.full_name in vocab.FEMALE_FIRST_NAMES
        elif r.gender is not None:
            assert r.full_name in vocab.MALE_FIRST_NAMES
        else:
            assert r.full_name in vocab.FEMALE_FIRST_NAMES + vocab.MALE_FIRST_NAMES


def test_deterministic_and_salted(cust):
    a = apply_mask_config(cust, MASK_CONFIG, salt="s1").orderBy("cust_id").collect()
    b = apply_mask_config(cust, MASK_CONFIG, salt="s1").orderBy("cust_id").collect()
    c = apply_mask_config(cust, MASK_CONFIG, salt="s2").orderBy("cust_id").collect()
    assert a == b and a != c


def test_config_order_later_sees_earlier(spark):
    df = spark.createDataFrame([("1", "Email", "x@y.z")], "id string, t string, v string")
    # contact_type is masked first (to a city name), so contact_details sees no email/phone -> null
    out = apply_mask_config(df, {"t": {"type": "city"},
                                 "v": {"type": "contact_details", "meta": {"contact_type_column_name": "t"}}}, salt="s")
    assert out.first().v is None


def test_keyed(cust):
    out = keyed_mask(cust, MASK_SPEC, salt="k")
    rows = out.join(cust.withColumnRenamed("contact_value", "orig").withColumnRenamed("full_name", "orig_name")
                    .select("cust_id", "orig", "orig_name"), "cust_id").collect()
    for r in rows:
        if r.orig is None or r.orig == "":
            assert r.contact_value == r.orig              # blanks and nulls stay
        elif "@" in r.orig:
            assert "@" in r.contact_value                 # Email provider
        elif r.orig[0].isdigit():
            assert r.contact_value.startswith("04")       # Phone provider
        assert r.full_name in vocab.FEMALE_FIRST_NAMES    # MockKwargs gender=female
    # unconfigured / empty-provider columns unchanged
    assert out.select("segment").collect() == cust.select("segment").collect()
    # consistent: equal (value, lookups) -> equal output
    dup = cust.union(cust)
    twice = keyed_mask(dup, MASK_SPEC, salt="k").groupBy("cust_id").agg(F.count_distinct("contact_value").alias("n"))
    assert twice.where("n > 1").count() == 0


def test_keyed_bad_spec(cust):
    with pytest.raises(RuntimeError):
        keyed_mask(cust, {"contact_value": {"IdLookup": ["nope"], "DataProvider": [{"ValueType": "All", "Function": "email"}]}}, salt="k")
    with pytest.raises(ValueError):
        keyed_mask(cust, {"contact_value": {"DataProvider": [{"ValueType": "All", "Function": "no_such_fn"}]}}, salt="k")


def test_redated_name(spark):
    df = spark.createDataFrame([("CUST_20230101.csv",), ("CUST.csv",), ("A_B_C",)], "n string")
    got = [r[0] for r in df.select(redated_name(F.col("n"), "20240102")).collect()]
    assert got == ["CUST_20240102.csv", "_20240102.csv", "A_B_20240102"]


def test_mask_job_files(spark, tmp_dir, cust):
    src = f"{tmp_dir}/src"
    cust.write.option("header", True).option("sep", ";").csv(src)
    with open(f"{tmp_dir}/cfg.json", "w") as f:
        json.dump(MASK_CONFIG, f)
    out = run_mask_job(spark, src, f"{tmp_dir}/out", f"{tmp_dir}/cfg.json", "csv", ";", salt="j")
    back = read_delimited(spark, f"{tmp_dir}/out", "csv", ";")
    assert back.count() == cust.count() and back.columns == cust.columns
    with pytest.raises(RuntimeError):
        read_delimited(spark, src, "json")


def test_keyed_dir(spark, tmp_dir, cust):
    src = f"{tmp_dir}/pipes"
    os.makedirs(src)
    rows = cust.collect()
    for name, part in (("CUST_A_20230101.csv", rows[::2]), ("CUST_B_20230101.csv", rows[1::2])):
        with open(f"{src}/{name}", "w") as f:
            f.write("|".join(cust.columns) + "\n")
            for r in part:
                f.write("|".join("" if v is None else str(v) for v in r) + "\n")
    with open(f"{tmp_dir}/spec.yaml", "w") as f:
        f.write("MockColumns:\n  contact_value:\n    IdLookup: [cust_id]\n    DataProvider:\n"
                "      - {ValueType: Email, Function: email}\n"
                "      - {ValueType: Phone, Function: phone_number, MockKwargs: {}}\n"
                "      - {ValueType: All, Function: firstname}\n")
    run_keyed_mask_dir(spark, src, f"{tmp_dir}/tgt", f"{tmp_dir}/spec.yaml", test_date="20240102", salt="k")
    names = sorted(os.listdir(f"{tmp_dir}/tgt"))
    assert [n for n in names if n.startswith("target_name=")] == [
        "target_name=CUST_A_20240102.csv", "target_name=CUST_B_20240102.csv"]
    back = spark.read.option("header", True).option("sep", "|").csv(f"{tmp_dir}/tgt")
    assert back.count() == len(rows)
    direct = [mask_pipe_files(df, {"MockColumns": MASK_SPEC["MockColumns"]}, "20240102", salt="k")
              for df in read_pipe_directory(spark, src)]
    assert [df.count() for df in direct] == [len(rows)]


def test_salt_is_required(cust):
    for salt in ("", None):
        with pytest.raises(ValueError, match="salt"):
            apply_mask_config(cust, MASK_CONFIG, salt=salt)
        with pytest.raises(ValueError, match="salt"):
            keyed_mask(cust, MASK_SPEC, salt=salt)


def test_all_problems_of_a_config_are_reported(cust):
    bad = {"nope": {"type": "city"}, "segment": {"type": "what"}, "contact_value": {"type": "contact_details"},
           "full_name": {"type": "firstname", "meta": {"gender_column_name": "sex"}}}
    with pytest.raises(RuntimeError) as e:
        validate_config(bad, cust.columns)
    assert len(e.value.problems) == 4


def test_key_columns_and_names_with_dots(spark):
    df = spark.createDataFrame([(str(i), "same", "F", "x@y.z") for i in range(50)], "`row.id` string, `home.city` string, `a``b` string, `e.mail` string")
    own = apply_mask_config(df, {"home.city": {"type": "city"}}, salt="s")
    assert own.columns == df.columns and len({r[1] for r in own.collect()}) == 1
    by_row = apply_mask_config(df, {"home.city": {"type": "city"}}, salt="s", key_columns={"home.city": ["row.id"]})
    assert len({r[1] for r in by_row.collect()}) > 5
    keyed = keyed_mask(df, {"e.mail": {"IdLookup": ["row.id", "a`b"], "DataProvider": [{"ValueType": "All", "Function": "email"}]}}, salt="s")
    assert all(r[3] != "x@y.z" and "@" in r[3] for r in keyed.collect())
    with pytest.raises(RuntimeError, match="key column"):
        apply_mask_config(df, {"home.city": {"type": "city"}}, salt="s", key_columns={"home.city": ["id"]})


def test_pipe_files_with_other_headers_quotes_breaks_and_blanks(spark, tmp_dir):
    src = f"{tmp_dir}/pipes"
    os.makedirs(src)
    a = 'id|email|note\n1|ann@real.com|"He said ""hi"" ok"\n2|bob@real.com|"two\nlines | bar"\n3||"  sp  "\n'
    b = 'email|id|note\neve@real.com|4|  x \n"q@real.com"|5|""\n'
    for name, text in (("A_1.csv", a), ("B_1.csv", b), ("C_1.csv", 'id|email|note\n6|cat@real.com|z\n')):
        with open(f"{src}/{name}", "w", newline="") as f:
            f.write(text)
    open(f"{src}/D_1.csv", "w").close()
    with open(f"{tmp_dir}/spec.json", "w") as f:
        json.dump({"MockColumns": {"email": {"IdLookup": ["id"], "DataProvider": [{"ValueType": "All", "Function": "email"}]}}}, f)
    assert run_keyed_mask_dir(spark, src, f"{tmp_dir}/tgt", f"{tmp_dir}/spec.json", test_date="2", salt="k") == 2
    got, raw = {}, ""
    for folder in sorted(os.listdir(f"{tmp_dir}/tgt")):
        if folder.startswith("target_name="):
            for part in sorted(os.listdir(f"{tmp_dir}/tgt/{folder}")):
                if part.endswith(".csv"):
                    with open(f"{tmp_dir}/tgt/{folder}/{part}", newline="") as f:
                        raw += f.read()
                    with open(f"{tmp_dir}/tgt/{folder}/{part}", newline="") as f:
                        for r in csv.DictReader(f, delimiter="|"):
                            got[r["id"]] = (folder[12:], r["email"], r["note"])
    assert "real.com" not in raw
    assert {k: (v[0], v[2]) for k, v in got.items()} == {
        "1": ("A_2.csv", 'He said "hi" ok'), "2": ("A_2.csv", "two\nlines | bar"), "3": ("A_2.csv", "  sp  "),
        "4": ("B_2.csv", "  x "), "5": ("B_2.csv", ""), "6": ("C_2.csv", "z")}
    assert got["3"][1] == "" and all("@" in got[k][1] for k in "12456")
    with open(f"{src}/E_1.csv", "w") as f:
        f.write("id|email|note\n7|x@real.com\n")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        run_keyed_mask_dir(spark, src, f"{tmp_dir}/tgt2", f"{tmp_dir}/spec.json", salt="k")


def test_config_is_one_file(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/c")
    for n in "ab":
        with open(f"{tmp_dir}/c/{n}.json", "w") as f:
            f.write("{}")
    with pytest.raises(ValueError, match="2 files"):
        load_mask_config(spark, f"{tmp_dir}/c")
    assert load_mask_config(spark, f"{tmp_dir}/c/a.json") == {}
