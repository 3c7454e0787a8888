"""Job A end to end on files: listing, layout pick, parse once, all outputs, summary."""

import os

import pytest

from paths import SF001
from tessera.plans.fixed_width_job import FixedWidthJob, run_fixed_width_job
from tessera.plans.fixtures import LINEITEM_LAYOUT_CSV, lineitem_records
from test_ingest import EXPECTED_SF001


def _land(spark, root, with_extra=True):
    """Write the lineitem records as one text file per file name, plus a layout and a marker."""
    rows = lineitem_records(spark, SF001).collect()
    by_file = {}
    for r in rows:
        by_file.setdefault(r.file_path.split("/")[-1], []).append(r.value)
    os.makedirs(f"{root}/in", exist_ok=True)
    for name, values in by_file.items():
        with open(f"{root}/in/{name}", "w") as f:
            f.write("\n".join(values) + "\n")
    if with_extra:
        open(f"{root}/in/LI.AU_Z_20240101.TXT", "w").close()          # listed, no rows
        with open(f"{root}/in/OTHER_20240101.TXT", "w") as f:           # not listed, not scanned
            f.write("x" * 54 + "\n")
    os.makedirs(f"{root}/meta", exist_ok=True)
    for name in ("LI_LAYOUT_20231231.csv", "LI_LAYOUT_20250101.csv"):
        with open(f"{root}/meta/{name}", "w") as f:
            f.write(LINEITEM_LAYOUT_CSV)
    names = sorted(by_file) + (["LI.AU_Z_20240101.TXT"] if with_extra else [])
    names.sort()
    with open(f"{root}/marker.txt", "w") as f:
        for n in names:
            f.write(f"{n}: {len(by_file.get(n, []))}\n")
    return by_file


@pytest.mark.parametrize("stage", ["persist", "parquet"])
def test_job_end_to_end(spark, tmp_dir, stage):
    by_file = _land(spark, tmp_dir)
    job = FixedWidthJob(data_dir=f"{tmp_dir}/in", layout_dir=f"{tmp_dir}/meta", file_prefix="LI.",
                        table_name="LINEITEM_FW", run_date="20240101", output_root=f"{tmp_dir}/out",
                        marker_path=f"{tmp_dir}/marker.txt", dataset="li", stage=stage,
                        job_run_date="2024-01-02 03:04:05")
    res = run_fixed_width_job(spark, job)
    assert res.layout_path.endswith("LI_LAYOUT_20231231.csv")
    good = sum(v[0] for v in EXPECTED_SF001.values())
    rejects = sum(v[1] for v in EXPECTED_SF001.values())
    errors = sum(v[2] for v in EXPECTED_SF001.values())
    assert res.counts == {"raw": good + rejects, "loaded": good, "exceptions": errors, "rejects": rejects,
                          "files": 7}
    assert res.marker_ok is True
    p = res.paths
    typed = spark.read.parquet(p["typed"])
    assert typed.count() == good
    assert typed.columns[-2:] == ["dataops_file_name_path", "dataops_li_region"]
    assert spark.read.parquet(p["exceptions"]).count() == errors
    assert spark.read.csv(p["dq_detail"]).count() == errors
    assert spark.read.csv(p["dq_header"]).first()[0] == "file_name"
    assert spark.read.text(p["rejects"]).count() == rejects
    summary = {r.file_name: r for r in spark.read.parquet(p["summary_parquet"]).collect()}
    assert set(summary) == set(by_file) | {"LI.AU_Z_20240101.TXT"}
    for name, (g, rj, _e, _rows, keys) in EXPECTED_SF001.items():
        r = summary[name]
        assert (r.source_file_record_count, r.record_length_rejection_count, r.total_records_loaded_count,
                r.clean_record_count, r.data_quality_issue_count, r.number_of_source_files) == (
            g + rj, rj, g, g - keys, keys, 7)
    z = summary["LI.AU_Z_20240101.TXT"]
    assert (z.source_file_record_count, z.total_records_loaded_count, z.data_quality_issue_count) == (0, 0, 0)
    assert spark.read.csv(p["summary_detail"]).count() == 7
    manifest = spark.read.parquet(p["manifest"]).collect()
    assert [(m.table_name, m.loaded_count) for m in manifest] == [("LINEITEM_FW_LANDED", good)]


def test_job_without_marker_and_rerun_overwrites(spark, tmp_dir):
    _land(spark, tmp_dir, with_extra=False)
    job = FixedWidthJob(data_dir=f"{tmp_dir}/in", layout_dir=f"{tmp_dir}/meta", file_prefix="LI.",
                        table_name="LINEITEM_FW", run_date="20240101", output_root=f"{tmp_dir}/out",
                        region_mode="three_way", stage="none", max_records_per_file=1000)
    first = run_fixed_width_job(spark, job)
    second = run_fixed_width_job(spark, job)
    assert first.counts == second.counts
    summary = spark.read.parquet(second.paths["summary_parquet"]).collect()
    assert {r.source_file_record_count for r in summary} == {None}
    assert {r.record_length_rejection_count for r in summary} == {first.counts["rejects"]}
    # overwrite, not append, for data outputs; the manifest keeps one row per run
    assert spark.read.parquet(second.paths["typed"]).count() == first.counts["loaded"]
    files = [f for f in os.listdir(second.paths["typed"]) if f.endswith(".parquet")]
    assert len(files) >= first.counts["loaded"] // 1000
    assert len(spark.read.parquet(second.paths["manifest"]).collect()) == 2


def test_clean_run_leaves_no_empty_parts_and_no_staged_data(spark, tmp_dir):
    _land(spark, tmp_dir, with_extra=False)
    job = FixedWidthJob(data_dir=f"{tmp_dir}/in", layout_dir=f"{tmp_dir}/meta", file_prefix="LI.", table_name="T",
                        run_date="20240101", output_root=f"{tmp_dir}/out", path_columns=False)
    dirty = run_fixed_width_job(spark, job)
    assert dirty.counts["rejects"] > 0 and os.path.isdir(dirty.paths["rejects"]) and os.path.isdir(dirty.paths["dq_detail"])
    assert spark.read.parquet(dirty.paths["typed"]).columns == [c.name for c in dirty.layout.output_columns]
    os.makedirs(f"{tmp_dir}/clean")
    with open(f"{tmp_dir}/clean/LI.AU_1.TXT", "w") as f:
        f.write("0000000001" + "01" + "20240101" + "+00001" + "00000000001.00" + "0.05  " + "A  " + "ZZZZZ" + "\n")
    job.data_dir = f"{tmp_dir}/clean"
    clean = run_fixed_width_job(spark, job)
    assert clean.counts == {"raw": 1, "loaded": 1, "exceptions": 0, "rejects": 0, "files": 1}
    assert not os.path.exists(clean.paths["rejects"]) and not os.path.exists(clean.paths["dq_detail"])
    stage = f"{spark.conf.get('spark.checkpoint.dir')}/tessera-{spark.sparkContext.applicationId}/tessera-stage/t"
    assert not os.path.isdir(stage) or os.listdir(stage) == []


def test_job_marker_mismatch(spark, tmp_dir):
    _land(spark, tmp_dir, with_extra=False)
    with open(f"{tmp_dir}/marker.txt", "a") as f:
        f.write("EXTRA: 1\n")
    job = FixedWidthJob(data_dir=f"{tmp_dir}/in", layout_dir=f"{tmp_dir}/meta", file_prefix="LI.",
                        table_name="T", run_date="20240101", output_root=f"{tmp_dir}/out",
                        marker_path=f"{tmp_dir}/marker.txt")
    res = run_fixed_width_job(spark, job)
    assert res.marker_ok is False
    assert spark.read.parquet(res.paths["summary_parquet"]).count() == 0
    job.on_marker_mismatch = "raise"
    landed = spark.read.parquet(res.paths["manifest"]).count()
    with pytest.raises(ValueError):
        run_fixed_width_job(spark, job)
    assert spark.read.parquet(res.paths["manifest"]).count() == landed  # a failed run is not announced


def test_job_no_layout(spark, tmp_dir):
    _land(spark, tmp_dir, with_extra=False)
    job = FixedWidthJob(data_dir=f"{tmp_dir}/in", layout_dir=f"{tmp_dir}/meta", file_prefix="LI.",
                        table_name="T", run_date="20200101", output_root=f"{tmp_dir}/out")
    with pytest.raises(FileNotFoundError):
        run_fixed_width_job(spark, job)


STEPS = ["write_parquet", "write_csv_detail", "write_header", "write_text", "announce"]


@pytest.mark.parametrize("step", STEPS)
def test_a_failed_run_leaves_the_last_one_readable(spark, tmp_dir, monkeypatch, step):
    from tessera.plans import fixed_width_job as fwj
    _land(spark, tmp_dir)
    job = FixedWidthJob(data_dir=f"{tmp_dir}/in", layout_dir=f"{tmp_dir}/meta", file_prefix="LI.", table_name="T",
                        run_date="20240101", output_root=f"{tmp_dir}/out", marker_path=f"{tmp_dir}/marker.txt")
    assert fwj.current_paths(spark, job) is None
    good = run_fixed_width_job(spark, job)

    def contents():
        p = fwj.current_paths(spark, job)
        return [sorted(map(str, spark.read.parquet(p[k]).collect())) for k in ("typed", "exceptions", "summary_parquet")] + [
            sorted(map(str, spark.read.text(p[k]).collect())) for k in ("dq_detail", "rejects", "summary_detail", "dq_header")]

    before = contents()
    with open(f"{tmp_dir}/in/LI.AU_A_20240101.TXT", "a") as f:
        f.write("x" * 54 + "\n" + "short\n")
    where = fwj.runs if step == "announce" else fwj.publish
    real = getattr(where, step)
    calls = []

    def failing(*args, **kwargs):
        calls.append(1)
        if len(calls) > failing.after:
            raise OSError("disk full")
        return real(*args, **kwargs)

    for failing.after in range(3 if step == "write_parquet" else 1):  # the first call, the second, ...
        calls.clear()
        monkeypatch.setattr(where, step, failing)
        try:
            run_fixed_width_job(spark, job)
        except OSError:
            assert contents() == before
            assert fwj.current_paths(spark, job) == good.paths
        else:
            break  # fewer calls than that: the run got through
        finally:
            monkeypatch.setattr(where, step, real)
    last = run_fixed_width_job(spark, job)
    assert last.run > good.run and fwj.current_paths(spark, job) == last.paths
    assert contents() != before and last.counts["rejects"] > good.counts["rejects"]


def test_old_runs_are_pruned_and_numbers_are_claimed_once(spark, tmp_dir):
    from tessera.sinks import runs
    folder = f"{tmp_dir}/runs/t"
    assert [runs.claim_run(spark, folder) for _ in range(5)] == [1, 2, 3, 4, 5]
    assert runs.prune_runs(spark, folder, [], 2) == []
    assert runs.prune_runs(spark, folder, [1, 3, 4], 2) == [1, 2]
    assert sorted(os.listdir(folder)) == ["3", "4", "5"]
    assert runs.claim_run(spark, folder) == 6
