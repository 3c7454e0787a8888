"""The streaming landing ingest processes each file once, with the batch job's rules."""

import os

from tessera.operators.ingest import ParseOptions
from tessera.operators.layout import Layout
from tessera.streaming.landing import start_landing_ingest


def test_landing_ingest(spark, tmp_dir):
    land = f"{tmp_dir}/land"
    os.makedirs(land)
    layout = Layout.from_fields([("ID", "numeric", 3, "Y"), ("D", "date", 8, "N")])
    with open(f"{land}/T.AU_1.TXT", "w") as f:
        f.write("00120240101\n002XXXXXXXX\nshort\n")
    opts = ParseOptions("T", extra_columns=("path", "region"))
    q = start_landing_ingest(spark, land, layout, opts, f"{tmp_dir}/out", f"{tmp_dir}/ckpt", "T.")
    q.awaitTermination(120)
    with open(f"{land}/T.NZ_2.TXT", "w") as f:
        f.write("00320231231\n")
    with open(f"{land}/OTHER.TXT", "w") as f:
        f.write("99920231231\n")
    q = start_landing_ingest(spark, land, layout, opts, f"{tmp_dir}/out", f"{tmp_dir}/ckpt", "T.")
    q.awaitTermination(120)
    typed = spark.read.parquet(f"{tmp_dir}/out/processed")
    assert sorted((r.ID, r.region) for r in typed.collect()) == [(1, "AU"), (2, "AU"), (3, "NZ")]
    assert spark.read.parquet(f"{tmp_dir}/out/exceptions").count() == 1
    assert spark.read.text(f"{tmp_dir}/out/rejects").count() == 1
    counts = spark.read.parquet(f"{tmp_dir}/out/file_counts").collect()
    assert sorted((r.file_path.split("/")[-1], r.raw_count) for r in counts) == [("T.AU_1.TXT", 3), ("T.NZ_2.TXT", 1)]
