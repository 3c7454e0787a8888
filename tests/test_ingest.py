"""Parsing lineitem records: counts must equal the FIXTURES §3 expectations."""

from pyspark.sql import functions as F

from paths import SF001
from tessera.operators.ingest import EXCEPTION_COLUMNS, ParseOptions, parse_lines
from tessera.operators.layout import Layout, layout_slices
from tessera.plans.fixtures import LINEITEM_TABLE, lineitem_layout, lineitem_records

# FIXTURES §3, sf0.001: file -> (good, rejects, errors, failing rows, distinct failing keys)
EXPECTED_SF001 = {
    "LI.AU_A_20240101.TXT": (960, 25, 196, 183, 175),
    "LI.AU_N_20240101.TXT": (968, 36, 219, 195, 185),
    "LI.AU_R_20240101.TXT": (968, 33, 213, 200, 188),
    "LI.NZ_A_20240101.TXT": (949, 28, 200, 184, 176),
    "LI.NZ_N_20240101.TXT": (1046, 20, 225, 205, 194),
    "LI.NZ_R_20240101.TXT": (937, 30, 190, 177, 171),
}
ERRORS_BY_COLUMN_SF001 = {"SHIP_DATE": 329, "QTY": 305, "EXT_PRICE": 237, "DISC": 372}


def parsed(spark, **kw):
    return parse_lines(lineitem_records(spark, SF001), lineitem_layout(),
                       ParseOptions(LINEITEM_TABLE, **kw))


def test_per_file_counts_match_fixtures(spark):
    rows = parsed(spark).file_counts().collect()
    got = {r.file_path.split("/")[-1]: (r.loaded_count, r.raw_count - r.loaded_count, r.dq_error_count,
                                        r.dq_row_count, r.dq_key_count) for r in rows}
    assert got == EXPECTED_SF001


def test_errors_by_column(spark):
    rows = parsed(spark).exceptions().groupBy("column_name").count().collect()
    assert {r.column_name: r["count"] for r in rows} == ERRORS_BY_COLUMN_SF001


def test_typed_schema_and_properties(spark):
    p = parsed(spark, extra_columns=("dataops_file_name_path", "dataops_li_region"))
    typed = p.typed()
    assert [f.name for f in typed.schema] == ["ORDER_KEY", "LINE_NO", "SHIP_DATE", "QTY", "EXT_PRICE", "DISC",
                                               "RETURN_FLAG", "dataops_file_name_path", "dataops_li_region"]
    assert [f.dataType.simpleString() for f in typed.schema][:7] == [
        "bigint", "bigint", "date", "bigint", "decimal(38,18)", "float", "string"]
    # layout columns never null; raw = good + rejected
    nulls = typed.select([F.count_if(F.col(c).isNull()).alias(c) for c in typed.columns[:7]]).first()
    assert all(v == 0 for v in nulls)
    raw = lineitem_records(spark, SF001).count()
    assert typed.count() + p.width_rejects().count() == raw
    regions = {r[0] for r in typed.select("dataops_li_region").distinct().collect()}
    assert regions == {"AU", "NZ"}


def test_exception_rows(spark):
    ex = parsed(spark).exceptions()
    assert tuple(ex.columns) == EXCEPTION_COLUMNS
    r = ex.where(F.col("column_name") == "SHIP_DATE").orderBy("row_business_key").first()
    assert r.column_value == "20231345"
    assert r.row_business_key.startswith("ORDER_KEY=") and "|LINE_NO=" in r.row_business_key
    assert (r.row_fixed_flag, r.row_fixed_timestamp, r.table_name) == ("N", "", LINEITEM_TABLE)
    assert r.file_name.startswith("LI.")


def test_custom_exception_names_and_no_extra_columns(spark):
    names = tuple(f"c{i}" for i in range(8))
    p = parsed(spark, extra_columns=None, exception_columns=names, region_mode="three_way")
    assert tuple(p.exceptions().columns) == names
    assert p.typed().columns[-1] == "RETURN_FLAG"


def test_region_modes(spark):
    lines = spark.createDataFrame(
        [("a" * 3, "/x/T.AU_1.TXT"), ("a" * 3, "/x/T.NZ_1.TXT"), ("a" * 3, "/x/T.US_1.TXT")],
        "value string, file_path string")
    layout = Layout.from_fields([("A", "string", 3, "N")])
    for mode, want in [("two_way", ["AU", "NZ", "NZ"]), ("three_way", ["AU", "NZ", ""]),
                       ("off", [None, None, None])]:
        p = parse_lines(lines, layout, ParseOptions("T", region_mode=mode, extra_columns=("p", "r")))
        got = [r.r for r in p.typed().orderBy("p").collect()]
        assert got == want, mode


def test_fillers_keys_and_blank_layout(spark):
    layout = Layout.from_fields([("ID", "numeric", 3, "Y"), ("FILLERS", "string", 2, "Y"),
                                 ("AMT", "amount", 6, "Y"), ("R", "rate", 4, "Y")])
    assert layout.record_length == 15 and layout.key_names == ("ID", "AMT", "R")
    lines = spark.createDataFrame([("007XX  5.  1e-5", "f")], "value string, file_path string")
    p = parse_lines(lines, layout, ParseOptions("T", extra_columns=None))
    row = p.typed().first()
    assert row.asDict() == {"ID": 7, "AMT": __import__("decimal").Decimal("5.00"), "R": row.R}
    key = p.frame.select("_key").first()[0]
    assert key == "ID=7|AMT=5.00|R=1e-05"


def test_layout_slices(spark):
    lines = lineitem_records(spark, SF001).where(F.length("value") == 54).limit(5)
    sl = layout_slices(lines, lineitem_layout())
    assert sl.count() == 5 * 7
    r = sl.where(F.col("column_name") == "SHIP_DATE").first()
    assert r.offset == 12 and r.column_length == 8 and len(r.slice) == 8


def test_non_ascii_records_use_character_offsets(spark):
    layout = Layout.from_fields([("A", "string", 3, "N"), ("B", "numeric", 3, "N"), ("C", "string", 2, "N")])
    lines = spark.createDataFrame([("äbc012xy", "f"), ("abc012xy", "f"), (" é  7 zz", "f")],
                                  "value string, file_path string")
    p = parse_lines(lines, layout, ParseOptions("T", extra_columns=None))
    got = sorted(tuple(r) for r in p.typed().collect())
    # Python slices by characters and strips Unicode whitespace (NBSP included)
    assert got == sorted([("äbc", 12, "xy"), ("abc", 12, "xy"), ("é", 7, "zz")])


def test_dq_per_file_by_row_and_key(spark):
    p = parsed(spark)
    by_key = {r.file_path.split("/")[-1]: r.dq_count for r in p.dq_per_file("key").collect()}
    by_row = {r.file_path.split("/")[-1]: r.dq_count for r in p.dq_per_file("row").collect()}
    assert by_key == {k: v[4] for k, v in EXPECTED_SF001.items()}
    assert by_row == {k: v[3] for k, v in EXPECTED_SF001.items()}


# FIXTURES §3, sf0.01: file -> (good, rejects, errors, failing rows, distinct failing keys)
EXPECTED_SF01 = {
    "LI.AU_A_20240101.TXT": (9782, 243, 2075, 1913, 1795),
    "LI.AU_N_20240101.TXT": (9721, 281, 2116, 1966, 1869),
    "LI.AU_R_20240101.TXT": (9804, 233, 2127, 1924, 1839),
    "LI.NZ_A_20240101.TXT": (9736, 267, 2120, 1945, 1857),
    "LI.NZ_N_20240101.TXT": (9663, 261, 2085, 1918, 1830),
    "LI.NZ_R_20240101.TXT": (9756, 253, 2165, 1989, 1899),
}
ERRORS_BY_COLUMN_SF01 = {"SHIP_DATE": 3185, "QTY": 3090, "EXT_PRICE": 2529, "DISC": 3884}


def test_per_file_counts_match_fixtures_sf01(spark):
    from paths import SF01
    p = parse_lines(lineitem_records(spark, SF01), lineitem_layout(), ParseOptions(LINEITEM_TABLE))
    rows = p.file_counts().collect()
    got = {r.file_path.split("/")[-1]: (r.loaded_count, r.raw_count - r.loaded_count, r.dq_error_count,
                                        r.dq_row_count, r.dq_key_count) for r in rows}
    assert got == EXPECTED_SF01
    by_col = {r.column_name: r["count"] for r in p.exceptions().groupBy("column_name").count().collect()}
    assert by_col == ERRORS_BY_COLUMN_SF01


def test_stage_holds_the_keys_of_failing_rows_only(spark, tmp_dir):
    whole = parsed(spark)
    staged, kept = parsed(spark).stage(f"{tmp_dir}/stage"), parsed(spark).persist()
    for p in (staged, kept):
        assert p.frame.where((F.col("_n_errors") > 0) != F.col("_key").isNotNull()).count() == 0
        for output in ("typed", "exceptions", "width_rejects", "file_counts"):
            a, b = getattr(p, output)(), getattr(whole, output)()
            assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0, output
    kept.unpersist()
