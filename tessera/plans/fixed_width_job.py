"""Job A end to end: list, pick layout, scan, parse once, write, reconcile.

Control flow on the driver is limited to launching Spark jobs; the only data
collected is the layout (one row per field) and row counts observed during
the writes.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ingest import ParseOptions, Parsed, parse_lines
from ..operators.layout import Layout, load_layout, pick_layout_as_of
from ..operators.recon import SUMMARY_COLUMNS, file_summary, job_timestamp, marker_mismatch, marker_problems
from ..session import remove_dir, shared_dir
from ..sinks import publish, runs
from ..sources.text import list_files, read_dir_lines, read_marker

log = logging.getLogger(__name__)


@dataclass
class FixedWidthJob:
    data_dir: str                  # folder of fixed-width text files
    layout_dir: str                # folder of dated layout CSVs
    file_prefix: str               # data files start with this (e.g. "LI.")
    table_name: str                # processed table name (outputs use lower case)
    run_date: str                  # YYYYMMDD: picks the layout, stamps the summary
    output_root: str               # every output goes under this folder, each run in its own
    marker_path: str | None = None # control counts; None -> no-marker summary (R3)
    date_pattern: str = "YYYYMMDD"
    region_mode: str = "two_way"
    dataset: str = "dataset"
    extra_columns: tuple[str, str] | None = None   # default: dataops_file_name_path, dataops_<dataset>_region
    path_columns: bool = True      # False: typed rows without the path and region columns (P7)
    exception_columns: tuple[str, ...] | None = None
    num_output_files: int | None = None   # fixed count: shuffles the typed rows once
    max_records_per_file: int | None = None  # bounds file size without a shuffle
    # Fixed file counts of the exception and reject outputs, for small feeds: each
    # shuffles its rows into that many tasks. None writes where the rows are.
    num_exception_files: int | None = None
    num_reject_files: int | None = None
    # parquet: parsed lines staged once under spark.checkpoint.dir and removed at the
    # end; persist: kept on the executors; none: every output parses again
    stage: str = "parquet"
    per_file_rejects: bool = False
    distinct_by: str = "key"
    on_marker_mismatch: str = "empty"   # empty | raise
    marker_match: str = "order"   # order: n-th line, n-th file by name | name: the name a line begins with
    job_run_date: str | None = None
    scan_all_files: bool = False   # True: scan the whole folder like the reference
    line_sep: str | None = None
    layout_path: str | None = None # a fixed layout file instead of the dated pick (S4)
    keep_runs: int = 2             # announced runs whose folders stay

    def runs_dir(self) -> str:
        return f"{self.output_root.rstrip('/')}/runs/{self.table_name.lower()}"

    def paths(self, run: int) -> dict[str, str]:
        """Where a run's outputs are; headers and manifest are shared by all runs."""
        # The folder names 01_detail and 00_header.
        t = self.table_name.lower()
        shared = self.output_root.rstrip("/")
        r = f"{self.runs_dir()}/{run}"
        return {
            "typed": f"{r}/processed/{t}",
            "exceptions": f"{r}/exceptions/{t}",
            "dq_detail": f"{r}/dq/01_detail/{t}",
            "dq_header": f"{shared}/dq/00_header",
            "rejects": f"{r}/rejects/{t}",
            "summary_detail": f"{r}/summary/01_detail/{t}",
            "summary_header": f"{shared}/summary/00_header",
            "summary_parquet": f"{r}/audit/{t}",
            "manifest": f"{shared}/landed",
        }


@dataclass
class JobResult:
    layout_path: str
    layout: Layout
    counts: dict[str, int] = field(default_factory=dict)
    paths: dict[str, str] = field(default_factory=dict)
    marker_ok: bool | None = None
    run: int | None = None


def current_paths(spark: SparkSession, job: FixedWidthJob) -> dict[str, str] | None:
    """Where the outputs of the last announced run are (K7); None before the first."""
    run = runs.current_run(spark, job.paths(0)["manifest"], job.table_name)
    return None if run is None else job.paths(run)


def resolve_layout(spark: SparkSession, job: FixedWidthJob) -> str:
    listing = list_files(spark, job.layout_dir)
    picked = pick_layout_as_of(listing, job.run_date, job.file_prefix).collect()
    if not picked:
        raise FileNotFoundError(
            f"no layout in {job.layout_dir} for prefix {job.file_prefix!r} dated on or before {job.run_date}")
    return picked[0].file_path


def run_fixed_width_job(spark: SparkSession, job: FixedWidthJob) -> JobResult:
    """Run the job into a new run folder and announce it; a failure at any step
    leaves ``current_paths`` with the run before."""
    inventory = list_files(spark, job.data_dir, job.file_prefix).cache()          # S5
    layout_path = job.layout_path or resolve_layout(spark, job)                 # S4
    layout = load_layout(spark, layout_path)                                    # S3
    run = runs.claim_run(spark, job.runs_dir())
    result = JobResult(layout_path, layout, paths=job.paths(run), run=run)

    extra = job.extra_columns or ("dataops_file_name_path", f"dataops_{job.dataset}_region")
    options = ParseOptions(job.table_name, job.date_pattern, job.region_mode, extra if job.path_columns else None,
                           **({"exception_columns": job.exception_columns} if job.exception_columns else {}))
    scan_prefix = None if job.scan_all_files else job.file_prefix
    lines = read_dir_lines(spark, job.data_dir, scan_prefix, job.line_sep)     # S1, S2
    parsed: Parsed = parse_lines(lines, layout, options)
    staged = None
    try:
        if job.stage == "parquet":
            staged = shared_dir(spark, "tessera-stage", job.table_name.lower())
            parsed.stage(staged)
        elif job.stage == "persist":
            parsed.persist()
        elif job.stage != "none":
            raise ValueError("stage must be persist, parquet or none")
        _publish(spark, job, result, parsed, inventory)
    finally:
        parsed.unpersist()
        inventory.unpersist()
        if staged is not None:
            remove_dir(spark, staged)
    return result


def _publish(spark: SparkSession, job: FixedWidthJob, result: JobResult, parsed: Parsed, inventory: DataFrame) -> None:
    """All outputs of the parsed lines; the landing row comes last."""
    paths = result.paths
    per_file = parsed.file_counts().cache()
    try:
        totals = per_file.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("raw_count", "loaded_count", "dq_error_count")]).first()
        marker = read_marker(spark, job.marker_path) if job.marker_path else None
        if marker is not None:
            if job.marker_match == "name":
                n_wrong = marker_problems(inventory, marker).count()
                result.marker_ok, msg = n_wrong == 0, f"{n_wrong} names have no single file and marker line"
            else:
                n_files, n_lines = marker_mismatch(inventory, marker)                        # R2
                result.marker_ok, msg = n_files == n_lines, f"{n_files} files but {n_lines} marker lines: the files cannot be reconciled"
            if not result.marker_ok:
                if job.on_marker_mismatch == "raise":
                    raise ValueError(msg)
                log.error(msg)

        loaded = publish.write_parquet(parsed.typed(), paths["typed"], job.num_output_files,     # K1
                                       job.max_records_per_file)
        n_exc = publish.write_parquet(parsed.exceptions(), paths["exceptions"], job.num_exception_files)  # K2
        if n_exc:                                                                           # F4
            # K3 (+K4): CSV copy of the exceptions, from the Parquet just written.
            written = spark.read.parquet(paths["exceptions"])
            publish.write_csv_detail(written, paths["dq_detail"], job.num_exception_files)
            publish.write_header(spark, written.columns, paths["dq_header"])
        n_rej = totals.raw_count - totals.loaded_count
        if n_rej:
            n_rej = publish.write_text(parsed.width_rejects(), paths["rejects"], job.num_reject_files)  # K5

        by = "dq_key_count" if job.distinct_by == "key" else "dq_row_count"
        stats = per_file.select("file_path", "raw_count", "loaded_count", F.col(by).alias("dq_count"))
        summary = file_summary(inventory, stats, None, table_name=job.table_name, order_date=job.run_date,
                               job_run_date=job.job_run_date or job_timestamp(), marker=marker,
                               per_file_rejects=job.per_file_rejects, match=job.marker_match).select(*SUMMARY_COLUMNS)
        publish.write_parquet(summary.coalesce(1), paths["summary_parquet"])
        publish.write_csv_detail(spark.read.parquet(paths["summary_parquet"]).orderBy("file_name").coalesce(1),
                                 paths["summary_detail"])                                      # K6
        publish.write_header(spark, list(SUMMARY_COLUMNS), paths["summary_header"])           # K4
        runs.announce(spark, paths["manifest"], table_name=job.table_name, order_date=job.run_date,   # K7, K8
                      run=result.run, output_path=paths["typed"], loaded=loaded, exceptions=n_exc, rejects=n_rej)
        runs.prune_runs(spark, job.runs_dir(), runs.announced_runs(spark, paths["manifest"], job.table_name), job.keep_runs)
        result.counts = {"raw": int(totals.raw_count), "loaded": loaded, "exceptions": n_exc, "rejects": n_rej,
                         "files": inventory.count()}
    finally:
        per_file.unpersist()
