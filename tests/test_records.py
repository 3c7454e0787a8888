"""Delimited files with quoted line breaks, split over many tasks; heads; line numbers."""

import csv
import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.operators.numbering import number_rows, number_split_lines, read_split_lines
from tessera.sources.delimited import headers, read_delimited, read_pipe_directory
from tessera.sources.records import Quoting, read_records, states
from tessera.sources.text import read_marker


@pytest.fixture()
def small_splits(spark):
    """Splits of a few bytes."""
    keys = {"spark.sql.files.maxPartitionBytes": "59", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def write(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data.encode())


def field(rng):
    kind = rng.randrange(8)
    if kind == 0:
        return '"' + "".join(rng.choice(['""', "\n", "|", "x", "\r\n", " ", "é"]) for _ in range(rng.randrange(0, 9))) + '"'
    if kind == 1:
        return '""'
    if kind == 2:
        return "  blanks "
    if kind == 3:
        return 'in" the middle'
    if kind == 4:
        return '"long\n' + "line\n" * rng.randrange(0, 30) + 'end"'
    return "".join(rng.choice("abc日 ") for _ in range(rng.randrange(0, 12)))


def pipe_file(seed, rows, end):
    rng = random.Random(seed)
    lines = ["a|b|c"] + ["|".join(["r" + str(k), field(rng), field(rng)]) for k in range(rows)]
    if rows > 5:
        lines.insert(3, "")
    return end.join(lines) + (end if seed % 2 else "")


def test_split_files_have_the_rows_of_whole_files(spark, tmp_dir, small_splits):
    for k, rows in enumerate([9, 1, 0, 30, 4, 12]):
        write(f"{tmp_dir}/in/f {k}+.csv", pipe_file(k, rows, "\n" if k % 3 else "\r\n"))
    write(f"{tmp_dir}/in/empty.csv", "")
    want = []
    for name in sorted(os.listdir(f"{tmp_dir}/in")):
        with open(f"{tmp_dir}/in/{name}", newline="") as f:
            want += [(*row, f"file://{tmp_dir}/in/{name}", name) for row in list(csv.reader(f, delimiter="|"))[1:] if row]
    split, = read_pipe_directory(spark, f"{tmp_dir}/in")
    assert split.columns == ["a", "b", "c", "_source_path", "_source_name"]
    assert sorted(tuple(r) for r in split.collect()) == sorted(want) and len(want) == 56
    # the reader of whole files turns the CR LF within quotes into LF where records end in CR LF
    whole, = read_pipe_directory(spark, f"{tmp_dir}/in", split=False)
    assert sorted(tuple(r) for r in whole.collect()) == sorted(tuple(x.replace("\r\n", "\n") if "/f 0" in r[3] or "/f 3" in r[3] else x for x in r) for r in want)
    spread = read_records(spark, f"{tmp_dir}/in/f 3+.csv", "|").select(F.spark_partition_id().alias("p")).distinct().count()
    assert spread > 5
    shuffled = read_records(spark, f"{tmp_dir}/in", "|", broadcast_splits=1).where(~F.col("first"))
    assert shuffled.count() == 56


def test_comma_files_with_line_breaks(spark, tmp_dir, small_splits):
    write(f"{tmp_dir}/in/a.csv", 'id,"the\nnote"\n1,"x,\n\n""y"""\n2,\n\n3,"' + "long\n" * 40 + '"\n')
    df = read_delimited(spark, f"{tmp_dir}/in", multi_line=True, empty_as_null=False)
    assert df.columns == ["id", "the\nnote"]
    assert sorted(tuple(r) for r in df.collect()) == [("1", 'x,\n\n"y"'), ("2", ""), ("3", "long\n" * 40)]
    write(f"{tmp_dir}/in/b.csv", "id,other\n")
    with pytest.raises(ValueError, match="2 different headers"):
        read_delimited(spark, f"{tmp_dir}/in", multi_line=True)


@pytest.mark.parametrize("row", ["1|2|3", "1"])
def test_wrong_field_counts_fail(spark, tmp_dir, row):
    write(f"{tmp_dir}/in/a.csv", f"a|b\n1|2\n{row}\n")
    df, = read_pipe_directory(spark, f"{tmp_dir}/in")
    with pytest.raises(Exception, match="MALFORMED|Malformed|malformed"):
        df.collect()


def test_states_follow_the_characters():
    rng = random.Random(7)

    def inside_after(line, inside):
        """Character by character: quotes open at a field's start, double within."""
        i, at_start = 0, not inside
        while i < len(line):
            ch = line[i]
            if inside:
                if ch == '"':
                    if line[i + 1:i + 2] == '"':
                        i += 1
                    else:
                        inside = False
            elif ch == "|":
                at_start = True
                i += 1
                continue
            elif ch == '"' and at_start:
                inside = True
            at_start = False
            i += 1
        return inside

    lines = ["".join(rng.choice('"|ab') for _ in range(rng.randrange(0, 9))) for _ in range(3000)]
    outside, inside = Quoting("|").after(pa.array(lines))
    assert outside.tolist() == [inside_after(x, False) for x in lines]
    assert inside.tolist() == [inside_after(x, True) for x in lines]
    for start in (False, True):
        want = [start]
        for o, i in zip(outside, inside, strict=True):
            want.append(bool(i if want[-1] else o))
        assert states(outside, inside, start).tolist() == want
    assert states(np.zeros(0, bool), np.zeros(0, bool), True).tolist() == [True]


def test_only_the_heads_of_files_are_read(spark, tmp_dir):
    row = "x" * 60 + "|" + "y" * 60 + "\n"
    for k in range(3):
        write(f"{tmp_dir}/in/big {k}%.csv", "a|b\n" + row * 20_000)  # 2.4 MB each
    write(f"{tmp_dir}/in/other.csv", '"a\nb"|c\n1|2\n')

    def bytes_read():
        return sum(s.getBytesRead() for s in spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics() if s.getScheme() == "file")

    before = bytes_read()
    found = headers(spark, f"{tmp_dir}/in", "|")
    assert {h: [os.path.basename(f) for f in files] for h, files in found.items()} == {
        ("a", "b"): ["big 0%.csv", "big 1%.csv", "big 2%.csv"], ("a\nb", "c"): ["other.csv"]}
    assert 0 < bytes_read() - before < 4 * 70_000  # a buffer a file


def test_headers_are_grouped(spark, tmp_dir):
    for name, text in (("a", "x|y\n1|2\n"), ("b", "\n\r\nx|y\r\n"), ("c", "y|x\n"), ("d", "")):
        write(f"{tmp_dir}/in/{name}.csv", text)
    found = headers(spark, f"{tmp_dir}/in", "|")
    assert {h: [os.path.basename(f) for f in files] for h, files in found.items()} == {("x", "y"): ["a.csv", "b.csv"], ("y", "x"): ["c.csv"]}
    write(f"{tmp_dir}/in/e.csv", "x||y\n")
    with pytest.raises(ValueError, match="empty or repeated"):
        headers(spark, f"{tmp_dir}/in", "|")


def test_line_numbers_of_many_unequal_files(spark, tmp_dir, small_splits):
    rng = random.Random(5)
    want = {}
    for k in range(9):
        lines = [f"F{k}: {rng.randrange(10**rng.randrange(1, 9))}" for _ in range(rng.choice([0, 1, 2, 7, 40]))]
        name = f"m{rng.randrange(10**6):06d}_{k}.txt"
        want[name] = lines
        write(f"{tmp_dir}/markers/{name}", "\n".join(lines) + ("\n" if lines and k % 2 else ""))
    rows = read_marker(spark, f"{tmp_dir}/markers", per_file=True).collect()
    got = {}
    for r in rows:
        got.setdefault(os.path.basename(r.file_path), {})[r.line_number] = r.line_content
    assert got == {n: dict(enumerate(ls, 1)) for n, ls in want.items() if ls}
    together = read_marker(spark, f"{tmp_dir}/markers").collect()
    assert [(r.line_number, r.line_content) for r in together] == list(enumerate([x for n in sorted(want) for x in want[n]], 1))
    assert number_split_lines(read_split_lines(spark, f"{tmp_dir}/markers")).select("_split").distinct().count() > 5


def test_row_numbers_by_ranges(spark):
    df = spark.range(1000).withColumn("v", (F.col("id") * 7919) % 1000).repartition(6)
    rows = number_rows(df, [F.col("v")], "n").collect()
    assert all(r.n == r.v + 1 for r in rows) and len(rows) == 1000
    assert number_rows(df.limit(0), [F.col("v")]).count() == 0
