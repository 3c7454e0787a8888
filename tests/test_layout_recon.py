"""Layouts from files, as-of pick, marker files and the reconciliation summary."""

import os

import pytest
from pyspark.sql import functions as F

from tessera.operators.layout import load_layout, pick_layout_as_of, read_layout_frame
from tessera.operators.recon import SUMMARY_COLUMNS, file_summary, marker_counts, marker_problems, run_counts
from tessera.sources.text import list_files, read_dir_lines, read_lines, read_marker


def write(path, text, mode="w", newline=None):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, mode, newline=newline) as f:
        f.write(text)


def test_layout_file(spark, tmp_dir):
    write(f"{tmp_dir}/L.csv", "1,ORDER-KEY, Numeric ,10,Y\n2,FILLERS,STRING,2,N\n3,AMT,AMOUNT,5, Y\n")
    layout = load_layout(spark, f"{tmp_dir}/L.csv")
    assert [c.name for c in layout.columns] == ["ORDER_KEY", "FILLERS", "AMT"]
    assert [c.offset for c in layout.columns] == [0, 10, 12]
    assert layout.record_length == 17 and layout.key_names == ("ORDER_KEY", "AMT")
    assert [c.datatype for c in layout.columns] == ["numeric", "string", "amount"]
    frame = read_layout_frame(spark, f"{tmp_dir}/L.csv").orderBy("position").collect()
    assert [r.offset for r in frame] == [0, 10, 12] and frame[0].record_length == 17


def test_pick_layout_as_of(spark, tmp_dir):
    for name in ["LI_LAYOUT_20230101.csv", "LI_LAYOUT_20231231.csv", "LI_LAYOUT_20240301.csv",
                 "LX_LAYOUT_20231230.csv", "LI_LAYOUT_20231345.csv", "LI_OLD.csv"]:
        write(f"{tmp_dir}/meta/{name}", "1,A,STRING,1,N\n")
    listing = list_files(spark, f"{tmp_dir}/meta")
    got = pick_layout_as_of(listing, "20240101", "LI.").collect()
    assert len(got) == 1 and got[0].file_path.endswith("LI_LAYOUT_20231231.csv")
    assert pick_layout_as_of(listing, "20220101", "LI.").count() == 0


def test_inventory_lines_marker(spark, tmp_dir):
    d = f"{tmp_dir}/data"
    write(f"{d}/LI.AU_1.TXT", "abc\r\ndef\r\n", newline="")
    write(f"{d}/LI.NZ 2.TXT", "ghi\n")
    write(f"{d}/LI.EMPTY.TXT", "")
    write(f"{d}/OTHER.TXT", "zzz\n")
    inv = list_files(spark, d, "LI.")
    assert sorted(r.file_name for r in inv.collect()) == ["LI.AU_1.TXT", "LI.EMPTY.TXT", "LI.NZ 2.TXT"]
    lines = read_dir_lines(spark, d, "LI.")
    got = sorted((r.value, r.file_path.split("/")[-1]) for r in lines.collect())
    assert got == [("abc", "LI.AU_1.TXT"), ("def", "LI.AU_1.TXT"), ("ghi", "LI.NZ 2.TXT")]
    # decoded paths of the scan join the decoded paths of the listing
    assert {r.file_path for r in lines.collect()} <= {r.file_path for r in inv.collect()}
    write(f"{tmp_dir}/marker.txt", "LI.AU_1.TXT: 2\nLI.EMPTY.TXT:0\nno digits here\n")
    m = read_marker(spark, f"{tmp_dir}/marker.txt").collect()
    assert [(r.line_number, r["count"]) for r in m] == [(1, 2), (2, 0), (3, None)]


def _stats(spark):
    inv = spark.createDataFrame([("/d/A.TXT", "A.TXT"), ("/d/B.TXT", "B.TXT"), ("/d/C.TXT", "C.TXT")],
                                "file_path string, file_name string")
    per_file = spark.createDataFrame([("/d/A.TXT", 10, 8, 0, 0), ("/d/B.TXT", 5, 5, 0, 0), ("/x/Z.TXT", 4, 4, 0, 0)],
                                     "file_path string, raw_count long, loaded_count long, dq_error_count long, dq_row_count long")
    dq = spark.createDataFrame([("/d/A.TXT", 3)], "file_path string, dq_count long")
    return inv, per_file, dq


def test_summary_with_marker(spark):
    inv, per_file, dq = _stats(spark)
    marker = marker_counts(spark.createDataFrame([("x: 11", 1), ("y: 5", 2), ("z:2", 3)], "value string, o int"),
                           order=F.col("o"))
    s = file_summary(inv, per_file, dq, table_name="T", order_date="20240101", job_run_date="2024-01-02 00:00:00",
                     marker=marker)
    assert tuple(s.columns) == SUMMARY_COLUMNS
    rows = [tuple(r) for r in s.collect()]
    assert rows == [("T", "A.TXT", "2024-01-01", "2024-01-02 00:00:00", 11, 3, 8, 5, 3, 3),
                    ("T", "B.TXT", "2024-01-01", "2024-01-02 00:00:00", 5, 0, 5, 5, 0, 3),
                    ("T", "C.TXT", "2024-01-01", "2024-01-02 00:00:00", 2, 2, 0, 0, 0, 3)]


def test_summary_marker_mismatch_is_empty(spark):
    inv, per_file, dq = _stats(spark)
    marker = marker_counts(spark.createDataFrame([("x: 11", 1)], "value string, o int"), order=F.col("o"))
    s = file_summary(inv, per_file, dq, table_name="T", order_date="20240101", job_run_date="t", marker=marker)
    assert s.count() == 0


def test_summary_without_marker(spark):
    inv, per_file, dq = _stats(spark)
    s = file_summary(inv, per_file, dq, table_name="T", order_date="20240101", job_run_date="t").collect()
    assert [(r.file_name, r.source_file_record_count, r.record_length_rejection_count) for r in s] == [
        ("A.TXT", None, 2), ("B.TXT", None, 2), ("C.TXT", None, 2)]
    s2 = file_summary(inv, per_file, dq, table_name="T", order_date="20240101", job_run_date="t",
                      per_file_rejects=True).collect()
    assert [r.record_length_rejection_count for r in s2] == [2, 0, 0]
    with pytest.raises(ValueError):
        file_summary(inv, per_file, dq, table_name="T", order_date="2024-01-01", job_run_date="t")


def test_run_counts(spark):
    inv, per_file, _ = _stats(spark)
    r = run_counts(per_file, inv).first()
    assert (r.raw_count, r.loaded_count, r.rejected_count, r.files_with_rows, r.number_of_source_files) == (
        15, 13, 2, 2, 3)


def test_marker_folder_numbers_each_file(spark, tmp_dir):
    write(f"{tmp_dir}/markers/a.txt", "A1: 1\nA2: 2\n")
    write(f"{tmp_dir}/markers/b.txt", "B1: 7\n")
    rows = read_marker(spark, f"{tmp_dir}/markers", per_file=True).collect()
    got = sorted((r.file_path.split("/")[-1], r.line_number, r["count"]) for r in rows)
    assert got == [("a.txt", 1, 1), ("a.txt", 2, 2), ("b.txt", 1, 7)]


def test_read_lines_explicit_paths(spark, tmp_dir):
    write(f"{tmp_dir}/x/a b+c.txt", "one\ntwo\n")
    rows = read_lines(spark, [f"{tmp_dir}/x/a b+c.txt"]).collect()
    assert [r.value for r in rows] == ["one", "two"]
    assert rows[0].file_path.endswith("/x/a b+c.txt")


def test_summary_join_on_base_name(spark):
    inv = spark.createDataFrame([("/d1/A.TXT", "A.TXT"), ("/d2/B.TXT", "B.TXT")], "file_path string, file_name string")
    per_file = spark.createDataFrame([("/other/A.TXT", 10, 8, 2)], "file_path string, raw_count long, loaded_count long, dq_count long")
    by_path = file_summary(inv, per_file, None, table_name="T", order_date="20240101", job_run_date="t").collect()
    by_name = file_summary(inv, per_file, None, table_name="T", order_date="20240101", job_run_date="t",
                           join_on="name").collect()
    assert [(r.file_name, r.total_records_loaded_count) for r in by_path] == [("A.TXT", 0), ("B.TXT", 0)]
    assert [(r.file_name, r.total_records_loaded_count, r.clean_record_count) for r in by_name] == [
        ("A.TXT", 8, 6), ("B.TXT", 0, 0)]


def test_counts_beyond_32_bits(spark):
    big = 3_000_000_000
    lines = spark.createDataFrame([(f"A: {big}",), ("B: 7",)], "value string")
    marker = marker_counts(lines, order=F.col("value"))
    assert [r["count"] for r in marker.collect()] == [big, 7]
    inventory = spark.createDataFrame([("/a", "A"), ("/b", "B")], "file_path string, file_name string")
    stats = spark.createDataFrame([("/a", big, big - 1, 5), ("/b", 7, 7, 0)], "file_path string, raw_count long, loaded_count long, dq_count long")
    kw = dict(table_name="T", order_date="20240101", job_run_date="x")
    rows = file_summary(inventory, stats, None, marker=marker, **kw).collect()
    assert (rows[0].source_file_record_count, rows[0].record_length_rejection_count, rows[0].total_records_loaded_count) == (big, 1, big - 1)
    alone = file_summary(inventory, stats.withColumn("loaded_count", F.lit(0).cast("long")), None, **kw).collect()
    assert alone[0].record_length_rejection_count == big + 7


def test_separate_failing_row_counts_are_joined(spark):
    inventory = spark.createDataFrame([("/a", "A"), ("/b", "B"), ("/c", "C")], "file_path string, file_name string")
    per_file = spark.createDataFrame([("/a", 5, 5), ("/b", 4, 3), ("/x", 1, 1)], "file_path string, raw_count long, loaded_count long")
    dq = spark.createDataFrame([("/b", 2)], "file_path string, dq_count long")
    rows = file_summary(inventory, per_file, dq, table_name="T", order_date="20240101", job_run_date="x").collect()
    assert [(r.file_name, r.total_records_loaded_count, r.clean_record_count, r.data_quality_issue_count) for r in rows] == [
        ("A", 5, 5, 0), ("B", 3, 1, 2), ("C", 0, 0, 0)]


def test_marker_by_name_takes_any_order_and_reports_the_rest(spark):
    inv = spark.createDataFrame([("/a/x", "x"), ("/a/y", "y"), ("/a/z", "z"), ("/b/z", "z"), ("/a/w", "w"), ("/a/v", "v")], "file_path string, file_name string")
    stats = spark.createDataFrame([(f"/a/{n}", 10, 8, 1) for n in "xyzwv"], "file_path string, raw_count long, loaded_count long, dq_count long")
    lines = ["v : 10", "gone: 4", "/in/y:11", "x: none", "z: 10", "w: 1", "w: 2", " : 5"]
    marker = marker_counts(spark.createDataFrame([(x, k) for k, x in enumerate(lines)], "value string, o int"), order=F.col("o"))
    rows = file_summary(inv, stats, None, table_name="T", order_date="20240101", job_run_date="t", marker=marker, match="name").collect()
    got = sorted((r.file_name, r.source_file_record_count, r.record_length_rejection_count) for r in rows if r.source_file_record_count is not None)
    assert got == [("v", 10, 2), ("y", 11, 3)] and len(rows) == 6
    problems = {r.file_name: (r.problem, r.n_files, r.n_lines) for r in marker_problems(inv, marker).collect()}
    assert problems == {"": ("no such file", 0, 1), "gone": ("no such file", 0, 1), "x": ("no count", 1, 1), "z": ("several files", 2, 1),
                        "w": ("several marker lines", 1, 2)}
    with pytest.raises(ValueError):
        file_summary(inv, stats, None, table_name="T", order_date="20240101", job_run_date="t", marker=marker, match="line")
