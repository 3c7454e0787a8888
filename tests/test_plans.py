"""Plan shapes: parsing and masking stay narrow, pruned and code-generated."""

import os

from pyspark.sql import functions as F

from paths import SF001
from tessera.operators.ingest import ParseOptions, parse_lines
from tessera.operators.mask import apply_mask_config, keyed_mask
from tessera.plans.fixtures import LINEITEM_LAYOUT_CSV, customer_contacts, lineitem_layout
from tessera.plans.queries import MASK_CONFIG, MASK_SPEC
from tessera.sources.text import read_dir_lines


def executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def _landed(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    rec = "000000000101" + "20240101" + "+00017" + "00000001234.50" + "5%    " + "N  " + "ZZZZZ"
    with open(f"{tmp_dir}/in/LI.AU_A.TXT", "w") as f:
        f.write((rec + "\n") * 50 + "short\n")
    return read_dir_lines(spark, f"{tmp_dir}/in", "LI.")


def test_parse_plan_is_one_codegen_stage_without_shuffle(spark, tmp_dir):
    p = parse_lines(_landed(spark, tmp_dir), lineitem_layout(), ParseOptions("T"))
    for df in (p.typed(), p.exceptions(), p.width_rejects()):
        plan = executed(df)
        assert "Exchange" not in plan, plan
        assert "WholeStageCodegen" in plan or "*(" in plan, plan
        # the width check is evaluated right above the scan
        assert "length(value" in plan
    assert p.typed().count() == 50 and p.width_rejects().count() == 1


def test_exception_filter_stays_above_generate(spark, tmp_dir):
    p = parse_lines(_landed(spark, tmp_dir), lineitem_layout(), ParseOptions("T"))
    plan = p.exceptions()._jdf.queryExecution().optimizedPlan().toString()
    # no inferred size(errors) > 0 filter pushed below the Generate
    assert "size(" not in plan


def test_file_counts_single_aggregation(spark, tmp_dir):
    p = parse_lines(_landed(spark, tmp_dir), lineitem_layout(), ParseOptions("T"))
    plan = executed(p.file_counts())
    assert plan.count("FileScan") == 1


def test_mask_plans_are_narrow_and_pruned(spark):
    spark.catalog.clearCache()  # other tests cache this input; look at the file scan itself
    cust = customer_contacts(spark, SF001)
    for df in (apply_mask_config(cust, MASK_CONFIG, salt="s"), keyed_mask(cust, MASK_SPEC, salt="s")):
        plan = executed(df)
        assert "Exchange" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
        assert "ReadSchema: struct<c_custkey:bigint,c_name:string,c_mktsegment:string>" in plan, plan
    one = executed(apply_mask_config(cust, MASK_CONFIG, salt="s").select("segment"))
    assert "ReadSchema: struct<c_mktsegment:string>" in one
