"""The registered query set: each takes ``(spark, sf_dir)`` and
returns a DataFrame computed over the whole driver tables.

Fixed-width queries run on ``lineitem_records`` (every lineitem row as a
record); masking queries run on ``customer_contacts``.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import convert as cv
from ..functions.text import base_name, py_strip
from ..operators.ingest import ParseOptions, Parsed, parse_lines
from ..operators.layout import layout_slices, load_layout, pick_layout_as_of, read_layout_frame
from ..operators.mask import apply_mask_config, config_problems, keyed_mask
from ..operators.recon import file_summary, marker_counts, marker_problems, run_counts
from ..session import ensure_checkpoint_dir, shared_dir
from .fixed_width_job import FixedWidthJob, current_paths, run_fixed_width_job
from ..sinks.publish import redated_name, write_delimited
from ..sources.config import load_mask_config
from ..sources.delimited import read_delimited, read_pipe_directory
from ..sources.text import read_marker
from .mask_job import run_keyed_mask_dir
from .fixtures import (LINEITEM_TABLE, clean_records, customer_contacts, land_lineitem, land_named, land_sources, lineitem_layout, lineitem_records,
                       table, wide_layout, wide_records, write_layout)

EXTRA = ("dataops_file_name_path", "dataops_li_region")
ORDER_DATE = "20240101"
JOB_RUN_DATE = "2024-01-02 03:04:05"
MASK_SALT = "tessera-r1"


def parsed_records(spark: SparkSession, sf_dir: str, region_mode: str = "two_way") -> Parsed:
    return parse_lines(lineitem_records(spark, sf_dir), lineitem_layout(),
                       ParseOptions(LINEITEM_TABLE, region_mode=region_mode, extra_columns=EXTRA))


# --- fixed-width ----------------------------------------------------------------

def fw_typed_rows(spark, sf_dir):
    return parsed_records(spark, sf_dir).typed()


def fw_exceptions(spark, sf_dir):
    return parsed_records(spark, sf_dir).exceptions()


def fw_width_rejects(spark, sf_dir):
    return parsed_records(spark, sf_dir).width_rejects()


def _region_rows(spark, sf_dir, mode):
    # Files of return flag 'A' carry neither region marker here, so the
    # three-way rule's third branch is exercised.
    lines = lineitem_records(spark, sf_dir).withColumn(
        "file_path", F.regexp_replace("file_path", r"\.NZ_A_", ".XX_A_"))
    p = parse_lines(lines, lineitem_layout(), ParseOptions(LINEITEM_TABLE, region_mode=mode, extra_columns=EXTRA))
    return p.typed().select("ORDER_KEY", "LINE_NO", F.col(EXTRA[0]).alias("file_path"),
                            F.col(EXTRA[1]).alias("region"))


def fw_region_two_way(spark, sf_dir):
    return _region_rows(spark, sf_dir, "two_way")


def fw_region_three_way(spark, sf_dir):
    return _region_rows(spark, sf_dir, "three_way")


def fw_base_name(spark, sf_dir):
    lines = lineitem_records(spark, sf_dir)
    return (lines.groupBy(base_name(F.col("file_path")).alias("file_name"))
            .agg(F.count(F.lit(1)).alias("line_count")))


def fw_counts(spark, sf_dir):
    return run_counts(parsed_records(spark, sf_dir).file_counts())


def fw_rows_per_file(spark, sf_dir):
    return (parsed_records(spark, sf_dir).file_counts()
            .select("file_path", "raw_count").orderBy("file_path"))


def fw_good_per_file(spark, sf_dir):
    return (parsed_records(spark, sf_dir).file_counts()
            .select("file_path", "loaded_count").orderBy("file_path"))


def fw_dq_per_file(spark, sf_dir):
    return (parsed_records(spark, sf_dir).dq_per_file()
            .select(base_name(F.col("file_path")).alias("file_name"), "dq_count").orderBy("file_name"))


def fw_layout(spark, sf_dir):
    """S3 A8 J4 C8 on a landed layout: each field's place, and what the records
    hold there."""
    path = shared_dir(spark, "tessera-layout")
    write_layout(spark, path)
    place = read_layout_frame(spark, path)
    layout = load_layout(spark, path)
    good = lineitem_records(spark, sf_dir).where(F.length("value") == layout.record_length)
    held = (layout_slices(good, layout).groupBy("position")
            .agg(F.count(F.lit(1)).alias("records"), F.min("slice").alias("least"), F.max("slice").alias("most")))
    return place.join(held, "position", "left")


def _date_texts(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    k = F.col("l_orderkey")
    ymd = F.date_format("l_shipdate", "yyyyMMdd")
    return li.select(
        "l_orderkey", "l_linenumber",
        # compact form with blanks, zero dates, bad months, pre-Gregorian days
        F.when(k % 13 == 0, F.lit("00000000")).when(k % 11 == 0, F.lit(""))
         .when(k % 17 == 0, F.concat(F.substring(ymd, 1, 4), F.lit("13"), F.substring(ymd, 7, 2)))
         .when(k % 41 == 0, F.concat(F.lit("1500"), F.substring(ymd, 5, 4)))
         .otherwise(ymd).alias("text_compact"),
        # month and day without zero padding: strptime reads e.g. 2023115 as 2023-11-05
        F.concat(F.year("l_shipdate").cast("string"), F.month("l_shipdate").cast("string"),
                 F.dayofmonth("l_shipdate").cast("string")).alias("text_unpadded"),
        # day/month/year with separators; day 31 pushed into 30-day months
        F.when(k % 7 == 0, F.concat(F.lit("31/"), F.date_format("l_shipdate", "MM/yyyy")))
         .otherwise(F.date_format("l_shipdate", "dd/MM/yyyy")).alias("text_dmy"),
        # ISO form, one in five with a space for the zero of the day
        F.when(k % 5 == 0, F.regexp_replace(F.date_format("l_shipdate", "yyyy-MM-dd"), "-0", "- "))
         .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("text_iso"),
    )


DATE_VARIANTS = (("compact", "YYYYMMDD"), ("unpadded", "yyyymmdd"), ("dmy", "DD/MM/YYYY"), ("iso", "YYYY-MM-DD"))


def fw_date_variants(spark, sf_dir):
    t = _date_texts(spark, sf_dir)
    cols = [F.col("l_orderkey"), F.col("l_linenumber")]
    for name, pattern in DATE_VARIANTS:
        t, c = cv.convert_one(t, py_strip(F.col(f"text_{name}")), "date", f"_{name}_", ["*"], pattern)
        cols += [c.value.alias(f"date_{name}"), c.bad.alias(f"bad_{name}")]
    return t.select(*cols)


def _number_texts(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    k = F.col("l_orderkey")
    price = F.format_string("%.2f", F.col("l_extendedprice"))
    qty = F.col("l_quantity").cast("int").cast("string")
    return li.select(
        "l_orderkey", "l_linenumber",
        F.when(k % 19 == 0, F.lit("12A"))
         .when(k % 7 == 0, F.concat(F.lit("-00"), qty))
         .when(k % 11 == 0, F.concat(F.lit("1_"), qty))
         .when(k % 13 == 0, F.lit("000"))
         .when(k % 17 == 0, F.lit("+"))
         .otherwise(F.concat(F.lit("+"), F.lpad(qty, 5, "0"))).alias("text_qty"),
        F.when(k % 23 == 0, F.lit("12,345.00"))
         .when(k % 7 == 0, F.concat(F.lit("."), F.substring_index(price, ".", -1)))
         .when(k % 11 == 0, F.concat(F.substring_index(price, ".", 1), F.lit(".")))
         .when(k % 13 == 0, F.lit(""))
         .when(k % 17 == 0, F.concat(qty, F.lit("E"), F.col("l_linenumber").cast("string")))
         .when(k % 29 == 0, F.concat(F.lit("00"), price, F.lit(".5")))
         .when(k % 31 == 0, F.concat(F.lit("-"), price))
         .otherwise(F.concat(F.lit("+"), F.lpad(price, 13, "0"))).alias("text_price"),
    )


def fw_number_clean(spark, sf_dir):
    t = _number_texts(spark, sf_dir)
    t, q = cv.convert_one(t, py_strip(F.col("text_qty")), "numeric", "_q_", ["*"])
    t, p = cv.convert_one(t, py_strip(F.col("text_price")), "amount", "_p_", ["*"])
    return t.select("l_orderkey", "l_linenumber",
                    q.error_text.alias("clean_qty"), q.value.alias("qty"), q.bad.alias("bad_qty"),
                    p.error_text.alias("clean_price"), p.value.alias("price"), p.bad.alias("bad_price"))


def _rate_texts(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    k = F.col("l_orderkey")
    return li.select(
        "l_orderkey", "l_linenumber",
        F.when(k % 29 == 0, F.lit("x%"))
         .when(k % 31 == 0, F.lit("abc"))
         .when(k % 13 == 0, F.lit(""))
         .when(k % 11 == 0, F.lit("%"))
         .when(k % 7 == 0, F.concat(F.format_string("%.0f", F.col("l_tax") * 100), F.lit("%%")))
         .when(F.col("l_linenumber") % 2 == 0, F.concat(F.format_string("%.0f", F.col("l_discount") * 100), F.lit("%")))
         .otherwise(F.format_string("%.2f", F.col("l_discount"))).alias("text_rate"),
    )


def fw_rate(spark, sf_dir):
    t = _rate_texts(spark, sf_dir)
    t, r = cv.convert_one(t, py_strip(F.col("text_rate")), "rate", "_r_", ["*"])
    return t.select("l_orderkey", "l_linenumber", "text_rate", r.value.alias("rate"),
                    r.bad.alias("bad_rate"), F.when(r.bad, r.message).alias("error_message"))


def fw_layout_as_of(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    d = F.date_format("o_orderdate", "yyyyMMdd")
    names = orders.select(F.explode(F.array(
        F.concat(F.lit("/layouts/LI_LAYOUT_"), d, F.lit(".csv")),
        F.concat(F.lit("/layouts/LX_LAYOUT_"), d, F.lit(".csv")),
        F.concat(F.lit("/layouts/LI_LAYOUT_"), F.substring(d, 1, 4), F.lit("13"), F.substring(d, 7, 2), F.lit(".csv")),
    )).alias("file_path")).distinct()
    return pick_layout_as_of(names, "19960101", "LI.")


def _marker_lines(stats: DataFrame) -> DataFrame:
    """Control counts as a source system would send them: ``NAME: <lines>``."""
    return stats.select(base_name(F.col("file_path")).alias("name"),
                        F.concat(base_name(F.col("file_path")), F.lit(": "),
                                 F.col("raw_count").cast("string")).alias("value"))


def per_file_stats(spark, sf_dir) -> DataFrame:
    """Per-file counts of the records, checkpointed (a few rows per file) so
    the inventory, marker and summary branches do not each re-parse."""
    ensure_checkpoint_dir(spark)
    return parsed_records(spark, sf_dir).summary_counts().checkpoint(eager=True)


def _stats_inventory(stats: DataFrame) -> DataFrame:
    return stats.select("file_path", base_name(F.col("file_path")).alias("file_name"))


def fw_marker_counts(spark, sf_dir):
    return marker_counts(_marker_lines(parsed_records(spark, sf_dir).file_counts()), order=F.col("name"))


def fw_summary_marker(spark, sf_dir):
    stats = per_file_stats(spark, sf_dir)
    marker = marker_counts(_marker_lines(stats), order=F.col("name"))
    return file_summary(_stats_inventory(stats), stats, None, table_name=LINEITEM_TABLE,
                        order_date=ORDER_DATE, job_run_date=JOB_RUN_DATE, marker=marker)


def _shuffled_marker(stats: DataFrame) -> DataFrame:
    """Control counts in another order than the files', with folders before the
    names; a file without a line, a line without a file, and a file with two."""
    name = base_name(F.col("file_path"))
    line = F.concat(F.lit("landing/"), name, F.lit(" : "), F.col("raw_count").cast("string"))
    lines = (stats.where(~F.endswith(name, F.lit("NZ_R_20240101.TXT"))).select(line.alias("value"))
             .unionByName(stats.where(F.endswith(name, F.lit("NZ_A_20240101.TXT"))).select(F.concat(name, F.lit(": 1")).alias("value")))
             .unionByName(stats.where(F.endswith(name, F.lit("NZ_R_20240101.TXT"))).select(F.lit("LI.LOST.TXT: 7").alias("value"))))
    return marker_counts(lines, order=F.md5("value"))


def fw_summary_by_name(spark, sf_dir):
    """J3 by name: a shuffled marker with lines that match no file, and none or two for some."""
    stats = per_file_stats(spark, sf_dir)
    return file_summary(_stats_inventory(stats), stats, None, table_name=LINEITEM_TABLE, order_date=ORDER_DATE, job_run_date=JOB_RUN_DATE,
                        marker=_shuffled_marker(stats), match="name")


def fw_marker_problems(spark, sf_dir):
    """J3 by name: what of that marker can't be matched."""
    stats = per_file_stats(spark, sf_dir)
    return marker_problems(_stats_inventory(stats), _shuffled_marker(stats))


def fw_summary_no_marker(spark, sf_dir):
    stats = per_file_stats(spark, sf_dir)
    return file_summary(_stats_inventory(stats), stats, None, table_name=LINEITEM_TABLE,
                        order_date=ORDER_DATE, job_run_date=JOB_RUN_DATE)


def _wide(spark, sf_dir) -> Parsed:
    return parse_lines(wide_records(spark, sf_dir), wide_layout(), ParseOptions(LINEITEM_TABLE, extra_columns=EXTRA))


def fw_wide_rows(spark, sf_dir):
    """P1 P3 C1-C7 on a layout of 56 fields, converted as one list per datatype."""
    return _wide(spark, sf_dir).typed()


def fw_wide_exceptions(spark, sf_dir):
    """D1-D4 of the same records."""
    return _wide(spark, sf_dir).exceptions()


def fw_no_path_columns(spark, sf_dir):
    """P7 switched off: the typed rows without path and region."""
    return parse_lines(lineitem_records(spark, sf_dir), lineitem_layout(), ParseOptions(LINEITEM_TABLE, extra_columns=None)).typed()


EXCEPTION_NAMES = ("src_file", "row_key", "tbl", "col", "val", "msg", "fixed", "fixed_at")


def fw_exception_names(spark, sf_dir):
    """The eight exception columns under other names."""
    options = ParseOptions(LINEITEM_TABLE, extra_columns=EXTRA, exception_columns=EXCEPTION_NAMES)
    return parse_lines(lineitem_records(spark, sf_dir), lineitem_layout(), options).exceptions()


def fw_join_counts(spark, sf_dir):
    """Loaded and failing rows as two tables; files without failing rows
    (those of every third order here) and listed files without rows count 0."""
    lines = lineitem_records(spark, sf_dir)
    clean = clean_records(spark, sf_dir).withColumn("file_path", F.replace("file_path", F.lit("/LI."), F.lit("/LI.CLEAN.")))
    parsed = parse_lines(lines.unionByName(clean), lineitem_layout(), ParseOptions(LINEITEM_TABLE, extra_columns=EXTRA)).save_counts()
    counts = parsed.file_counts().select("file_path", "raw_count", "loaded_count")
    listed = counts.select("file_path").unionByName(counts.select(F.concat("file_path", F.lit(".EMPTY")).alias("file_path")))
    inventory = listed.select("file_path", base_name(F.col("file_path")).alias("file_name"))
    return file_summary(inventory, counts, parsed.dq_per_file(), table_name=LINEITEM_TABLE, order_date=ORDER_DATE, job_run_date=JOB_RUN_DATE,
                        per_file_rejects=True)


def fw_marker_numbers(spark, sf_dir):
    """Line numbers within every file of a folder of markers of unequal
    length, one file per customer nation."""
    root = shared_dir(spark, "tessera-markers")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    lines = customers.where("c_custkey % 25 >= c_nationkey").select("c_nationkey", "c_custkey", F.concat(
        F.lit("F"), "c_custkey", F.when(F.col("c_custkey") % 7 == 0, F.lit(" none")).otherwise(F.concat(F.lit(": "), F.col("c_custkey") * 3))).alias("value"))
    (lines.repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey").select("c_nationkey", "value")
     .write.partitionBy("c_nationkey").text(root))
    numbered = read_marker(spark, root, per_file=True)
    nation = F.regexp_extract("file_path", "c_nationkey=([0-9]+)/", 1).cast("int")
    return numbered.select(nation.alias("nation"), "line_number", "line_content", "count")


# --- masking ----------------------------------------------------------------------

MASK_TYPE_TARGETS = {
    # type -> (column masked, config)
    "firstname": ("full_name", {"type": "firstname", "meta": {"gender_column_name": "gender"}}),
    "lastname": ("full_name", {"type": "lastname", "meta": {"gender_column_name": "gender"}}),
    "date_of_birth": ("cust_id", {"type": "date_of_birth"}),
    "street_number": ("cust_id", {"type": "street_number"}),
    "street_name": ("segment", {"type": "street_name"}),
    "street_suffix": ("segment", {"type": "street_suffix"}),
    "city": ("segment", {"type": "city"}),
    "state": ("segment", {"type": "state"}),
    "zip_code": ("cust_id", {"type": "zip_code"}),
    "email": ("contact_value", {"type": "email"}),
    "phone_number": ("contact_value", {"type": "phone_number"}),
    "contact_details": ("contact_value", {"type": "contact_details",
                                          "meta": {"contact_type_column_name": "contact_type"}}),
    "account_number": ("cust_id", {"type": "account_number"}),
    "drivers_license": ("full_name", {"type": "drivers_license"}),
}

# FIXTURES §5 configs.
MASK_CONFIG = {
    "full_name": {"type": "firstname", "meta": {"gender_column_name": "gender"}},
    "contact_value": {"type": "contact_details", "meta": {"contact_type_column_name": "contact_type"}},
    "segment": {"type": "city"},
}
MASK_FILE_CONFIG = {
    "full_name": {"type": "lastname", "meta": {"gender_column_name": "gender"}},
    "gender": {"type": "state"},
    "contact_type": {"type": "street_suffix"},
    "contact_value": {"type": "contact_details", "meta": {"contact_type_column_name": "contact_type"}},
}
MIXED_COLUMNS = ["cust_id", "contact_value", "full_name", "gender", "note"]
CONTACT_COLUMNS = ["cust_id", "full_name", "gender", "contact_type", "contact_value", "segment"]
MASK_SPEC = {"MockColumns": {
    "contact_value": {"IdLookup": ["cust_id"], "DataProvider": [
        {"ValueType": "Email", "Function": "email"},
        {"ValueType": "Phone", "Function": "phone_number", "MockKwargs": {}},
        {"ValueType": "All", "Function": "firstname"}]},
    "full_name": {"IdLookup": ["gender"], "DataProvider": [
        {"ValueType": "All", "Function": "firstname", "MockKwargs": {"gender": "female"}}]},
    "segment": {"DataProvider": []},
}}


def _mask_type_query(type_name):
    column, cfg = MASK_TYPE_TARGETS[type_name]

    def q(spark, sf_dir):
        cust = customer_contacts(spark, sf_dir).withColumn("row_id", F.col("cust_id"))
        out = apply_mask_config(cust, {column: cfg}, salt=MASK_SALT)
        return out.select(F.col("row_id").alias("cust_id"), F.col(column).alias("masked"))
    q.__name__ = f"mask_{type_name}"
    return q


def mask_config(spark, sf_dir):
    return apply_mask_config(customer_contacts(spark, sf_dir), MASK_CONFIG, salt=MASK_SALT)


def mask_keyed(spark, sf_dir):
    return keyed_mask(customer_contacts(spark, sf_dir), MASK_SPEC, salt=MASK_SALT)


# One column masked by each: column, function, arguments.
MASK_FUNCTIONS = {
    "mask_phone_template": ("contact_value", "phone_number", {"mask": "+61 4## ### ###"}),
    "mask_mail_domains": ("contact_value", "email", {"domains": ["corp.example", "@mail.corp.example", "post.example"]}),
    "mask_full_name": ("full_name", "full_name", {"gender": "female", "reverse": True}),
    "mask_address": ("segment", "address", {}),
    "mask_user_name": ("full_name", "user_name", {"mask": "{firstname}_[a|bc|d][7-12]"}),
    "mask_code_template": ("contact_value", "template", {"template": r"@@-####-??\#"}),
    "mask_distinct_number": ("cust_id", "distinct_number", {}),
}


def _mask_function_query(name):
    column, function, kwargs = MASK_FUNCTIONS[name]
    spec = {column: {"DataProvider": [{"ValueType": "All", "Function": function, "MockKwargs": kwargs}]}}

    def q(spark, sf_dir):
        rows = customer_contacts(spark, sf_dir).withColumn("row_id", F.col("cust_id"))
        return keyed_mask(rows, spec, salt=MASK_SALT).select(F.col("row_id").alias("cust_id"), F.col(column).alias("masked"))
    q.__name__ = name
    return q


def mask_config_problems(spark, sf_dir):
    """V1-V3: a configuration with one entry per supplier, read from disk, and
    all that is wrong with it for the contact table."""
    k = F.col("s_suppkey")
    entry = F.struct(
        F.when(k % 3 == 0, F.lit("city")).when(k % 3 == 1, F.lit("contact_details")).otherwise(F.concat(F.lit("kind"), k % 5)).alias("type"),
        F.when(k % 4 == 1, F.struct(F.lit("contact_type").alias("contact_type_column_name")))
         .when(k % 4 == 2, F.struct(F.concat(F.lit("no_"), k).alias("contact_type_column_name"))).alias("meta"))
    path = shared_dir(spark, "tessera-config")
    pairs = table(spark, sf_dir, "supplier").select(F.concat(F.lit('"'), "s_name", F.lit('": '), F.to_json(entry)).alias("pair"))
    (pairs.groupBy().agg(F.array_sort(F.collect_list("pair")).alias("pairs"))
     .select(F.concat(F.lit("{"), F.array_join("pairs", ", "), F.lit("}"))).write.text(path))
    columns = customer_contacts(spark, sf_dir).columns
    return spark.createDataFrame([(p,) for p in config_problems(load_mask_config(spark, path), columns)], "problem string")


# --- write-and-read-back ---------------------------------------------------------------

def fw_sink_roundtrip(spark, sf_dir):
    """Land the records as text files (one folder per
    source file name), run the whole job into a fresh shared folder, and read
    the typed table back (path column left out: it names the landed files)."""
    root = shared_dir(spark, "tessera-roundtrip")
    land_lineitem(spark, sf_dir, root)
    job = FixedWidthJob(data_dir=f"{root}/in", layout_dir=f"{root}/layout", file_prefix="part-",
                        table_name=LINEITEM_TABLE, run_date=ORDER_DATE, output_root=f"{root}/out",
                        dataset="li", layout_path=f"{root}/layout", job_run_date=JOB_RUN_DATE)
    result = run_fixed_width_job(spark, job)
    return spark.read.parquet(result.paths["typed"]).drop("dataops_file_name_path")


def _run_job(spark, sf_dir, **options):
    """The whole job on a landing folder with real names, an empty file, a file
    of another feed and control counts."""
    root = shared_dir(spark, "tessera-job")
    land_named(spark, sf_dir, root)
    settings = {"marker_path": f"{root}/marker"} | options
    return run_fixed_width_job(spark, FixedWidthJob(
        data_dir=f"{root}/in", layout_dir=f"{root}/layout", layout_path=f"{root}/layout", file_prefix="LI.",
        table_name=LINEITEM_TABLE, run_date=ORDER_DATE, output_root=f"{root}/out", dataset="li", job_run_date=JOB_RUN_DATE,
        **settings))


def fw_job_exceptions(spark, sf_dir):
    """K2."""
    return spark.read.parquet(_run_job(spark, sf_dir).paths["exceptions"])


def fw_job_exceptions_csv(spark, sf_dir):
    """K3 under K4's column names; an empty text comes back from CSV as null."""
    paths = _run_job(spark, sf_dir).paths
    names = [spark.read.csv(paths["dq_header"]).first()[i] for i in range(8)]
    return spark.read.csv(paths["dq_detail"]).toDF(*names).na.fill("")


def fw_job_rejects(spark, sf_dir):
    """K5."""
    return spark.read.text(_run_job(spark, sf_dir).paths["rejects"])


def fw_job_summary(spark, sf_dir):
    """S5 S6 W1 J2 R1 K6, with the CSV copy's row count beside the table's rows."""
    paths = _run_job(spark, sf_dir).paths
    copies = spark.read.csv(paths["summary_detail"]).groupBy(F.col("_c1").alias("file_name")).agg(F.count(F.lit(1)).alias("csv_rows"))
    return spark.read.parquet(paths["summary_parquet"]).join(copies, "file_name", "left")


def fw_marker_mismatch(spark, sf_dir):
    """R2: control counts of another number of files give no summary rows, but
    the data lands."""
    marker = shared_dir(spark, "tessera-marker")
    spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.concat("n_name", F.lit(": 1"))).coalesce(1).write.text(marker)
    paths = _run_job(spark, sf_dir, marker_path=marker).paths
    landed = spark.read.parquet(paths["manifest"]).select("table_name", "loaded_count")
    rows = spark.read.parquet(paths["summary_parquet"]).groupBy(F.upper(F.concat("table_name", F.lit("_LANDED"))).alias("table_name")).count()
    return landed.join(rows, "table_name", "left").select("table_name", "loaded_count", F.coalesce("count", F.lit(0)).alias("summary_rows"))


def fw_job_headers(spark, sf_dir):
    """The two header files, one row per column."""
    paths = _run_job(spark, sf_dir).paths
    parts = [spark.read.csv(paths[k]).select(F.posexplode(F.array("*")).alias("position", "name")).withColumn("header", F.lit(k))
             for k in ("dq_header", "summary_header")]
    return parts[0].unionByName(parts[1])


def fw_job_manifest(spark, sf_dir):
    """K7, without the time and the folder."""
    return spark.read.parquet(_run_job(spark, sf_dir).paths["manifest"]).drop("landed_at", "output_path")


def fw_clean_feed(spark, sf_dir):
    """a feed without errors and rejects: what was loaded, and which of the
    outputs for errors and rejects were written."""
    root = shared_dir(spark, "tessera-clean")
    land_sources(spark, clean_records(spark, sf_dir), f"{root}/in")
    write_layout(spark, f"{root}/layout")
    result = run_fixed_width_job(spark, FixedWidthJob(
        data_dir=f"{root}/in", layout_dir=f"{root}/layout", layout_path=f"{root}/layout", file_prefix="part-", table_name=LINEITEM_TABLE,
        run_date=ORDER_DATE, output_root=f"{root}/out", dataset="li", job_run_date=JOB_RUN_DATE))
    there = [F.lit(_exists(spark, result.paths[k])).alias(f"has_{k}") for k in ("dq_detail", "dq_header", "rejects")]
    manifest = spark.read.parquet(result.paths["manifest"]).select("loaded_count", "exception_count", "reject_count")
    return manifest.select("*", F.lit(spark.read.parquet(result.paths["exceptions"]).count()).alias("exception_rows"), *there)


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def fw_second_run(spark, sf_dir):
    """K8: a run over the records, then one over the clean ones only; readers
    are turned from the first run's rows to the second's."""
    root = shared_dir(spark, "tessera-second")
    land_lineitem(spark, sf_dir, root)
    land_sources(spark, clean_records(spark, sf_dir), f"{root}/second")
    settings = dict(layout_dir=f"{root}/layout", layout_path=f"{root}/layout", file_prefix="part-", table_name=LINEITEM_TABLE,
                    run_date=ORDER_DATE, output_root=f"{root}/out", dataset="li", job_run_date=JOB_RUN_DATE)
    counts = []
    for folder in ("in", "second"):
        job = FixedWidthJob(data_dir=f"{root}/{folder}", **settings)
        run = run_fixed_width_job(spark, job).run
        current = current_paths(spark, job)
        rows = [spark.read.parquet(current[k]).agg(F.count(F.lit(1)).alias("n")) for k in ("typed", "exceptions")]
        counts.append(rows[0].select(F.lit(run).cast("long").alias("run"), F.col("n").alias("typed_rows")).withColumn("_one", F.lit(1))
                      .join(rows[1].select(F.col("n").alias("exception_rows"), F.lit(1).alias("_one")), "_one").drop("_one"))
    return counts[0].unionByName(counts[1])


def fw_target_names(spark, sf_dir):
    """K10 on names with and without suffix, dots and underscores."""
    k = F.col("c_custkey")
    name = (F.when(k % 5 == 0, F.concat(F.lit("CUST_"), k, F.lit("_20230101.csv"))).when(k % 5 == 1, F.concat(F.lit("CUST"), k, F.lit(".csv")))
            .when(k % 5 == 2, F.concat(F.lit("A_B_"), k)).when(k % 5 == 3, F.concat(F.lit("x.y_"), k, F.lit("_z.tar.gz"))).otherwise(F.lit("plain")))
    named = table(spark, sf_dir, "customer").select("c_custkey", name.alias("source_name"))
    return named.select("c_custkey", "source_name", redated_name(F.col("source_name"), ORDER_DATE).alias("target_name"))


def mask_config_from_file(spark, sf_dir):
    """A configuration read from disk; ``gender`` is masked after it has
    chosen the names, ``contact_type`` before it chooses the contact."""
    path = shared_dir(spark, "tessera-config")
    spark.createDataFrame([(json.dumps(MASK_FILE_CONFIG),)], "value string").coalesce(1).write.text(path)
    return apply_mask_config(customer_contacts(spark, sf_dir), load_mask_config(spark, path), salt=MASK_SALT)


def mask_csv_mixed_headers(spark, sf_dir):
    """Pipe files of two column orders, with quotes, line breaks and blanks
    in a field, masked by key and read back."""
    root = shared_dir(spark, "tessera-mixed")
    k = F.col("cust_id").cast("long")
    note = (F.when(k % 4 == 0, F.concat(F.lit('say "'), "segment", F.lit('" | x'))).when(k % 4 == 1, F.concat(F.lit("  "), F.col("segment"), F.lit(" ")))
            .when(k % 4 == 2, F.concat(F.col("segment"), F.lit("\nsecond line"))).otherwise(F.lit("")))
    rows = customer_contacts(spark, sf_dir).withColumn("note", note).na.fill("")
    for part, columns in enumerate((MIXED_COLUMNS, MIXED_COLUMNS[::-1])):
        write_delimited(rows.where(k % 2 == part).select(*columns), f"{root}/src/half={part}", "csv", "|", quote_empty=False)
    spec = f"{root}/spec"
    spark.createDataFrame([(json.dumps(MASK_SPEC),)], "value string").coalesce(1).write.text(spec)
    run_keyed_mask_dir(spark, f"{root}/src", f"{root}/tgt", spec, salt=MASK_SALT)
    back = read_pipe_directory(spark, f"{root}/tgt")
    parts = [df.select(*MIXED_COLUMNS) for df in back]
    return parts[0].unionByName(parts[1])


def mask_csv_roundtrip(spark, sf_dir):
    """Write the customer table as pipe-delimited files (one
    folder per segment), mask the folder by key, read the masked files back."""
    root = shared_dir(spark, "tessera-mask-roundtrip")
    write_delimited(customer_contacts(spark, sf_dir), f"{root}/src", "csv", "|",
                    partition_by="segment", quote_empty=False)
    spec_path = f"{root}/spec"
    spark.createDataFrame([(json.dumps(MASK_SPEC),)], "value string").coalesce(1).write.text(spec_path)
    run_keyed_mask_dir(spark, f"{root}/src", f"{root}/tgt", spec_path, test_date=ORDER_DATE, salt=MASK_SALT)
    back = read_delimited(spark, f"{root}/tgt", "csv", "|", empty_as_null=False)
    return back.select(*CONTACT_COLUMNS)


def registry() -> dict:
    q = {
        "fw_typed_rows": fw_typed_rows,
        "fw_date_variants": fw_date_variants,
        "fw_number_clean": fw_number_clean,
        "fw_rate": fw_rate,
        "fw_width_rejects": fw_width_rejects,
        "fw_region_two_way": fw_region_two_way,
        "fw_region_three_way": fw_region_three_way,
        "fw_base_name": fw_base_name,
        "fw_exceptions": fw_exceptions,
        "fw_counts": fw_counts,
        "fw_rows_per_file": fw_rows_per_file,
        "fw_good_per_file": fw_good_per_file,
        "fw_dq_per_file": fw_dq_per_file,
        "fw_layout": fw_layout,
        "fw_layout_as_of": fw_layout_as_of,
        "fw_marker_counts": fw_marker_counts,
        "fw_summary_marker": fw_summary_marker,
        "fw_summary_no_marker": fw_summary_no_marker,
        "fw_sink_roundtrip": fw_sink_roundtrip,
    }
    for type_name in MASK_TYPE_TARGETS:
        q[f"mask_{type_name}"] = _mask_type_query(type_name)
    for name in MASK_FUNCTIONS:
        q[name] = _mask_function_query(name)
    for f in (fw_wide_rows, fw_wide_exceptions, fw_no_path_columns, fw_exception_names, fw_join_counts, fw_marker_numbers, fw_summary_by_name, fw_marker_problems, fw_clean_feed,
              fw_second_run, mask_config_problems, fw_job_exceptions, fw_job_exceptions_csv, fw_job_rejects, fw_job_summary, fw_marker_mismatch, fw_job_headers,
              fw_job_manifest, fw_target_names, mask_config_from_file, mask_csv_mixed_headers):
        q[f.__name__] = f
    q["mask_config"] = mask_config
    q["mask_keyed"] = mask_keyed
    q["mask_csv_roundtrip"] = mask_csv_roundtrip
    return q
