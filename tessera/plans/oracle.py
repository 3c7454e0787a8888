"""DuckDB SQL that re-derives every registered query from the driver's tables.

Used by ``__spark_entry__.oracle_sql`` as the correctness gate: the SQL is a
separate formulation (CTEs, UNION ALL, CASE) of the same documented rules; it
shares only fixed values (patterns, messages, word lists) with the Spark code.
"""

from __future__ import annotations

import datetime
import math
from typing import NamedTuple

from ..functions import vocab
from . import queries as qs
from .fixtures import CONTACT_SQL, LINEITEM_TABLE

CONTACT_COLUMNS = list(CONTACT_SQL)



class Field(NamedTuple):
    position: int
    name: str
    datatype: str
    offset: int
    length: int
    is_key: bool


# What the queries must give, written out here so that no wrong pattern, offset
# or name of the library can stand on both sides of a comparison.
FIELDS = (
    Field(0, "ORDER_KEY", "numeric", 0, 10, True), Field(1, "LINE_NO", "numeric", 10, 2, True),
    Field(2, "SHIP_DATE", "date", 12, 8, False), Field(3, "QTY", "snumeric", 20, 6, False),
    Field(4, "EXT_PRICE", "amount", 26, 14, False), Field(5, "DISC", "rate", 40, 6, False),
    Field(6, "RETURN_FLAG", "string", 46, 3, False),
)
RECORD_LENGTH = 54
EXCEPTION_COLUMNS = ("file_name", "row_business_key", "table_name", "column_name", "column_value", "error_message",
                     "row_fixed_flag", "row_fixed_timestamp")
MSG_DATE = "Failed to parse date value as it doesn't have date value in a format YYYYMMDD"
MSG_LONG = "Failed to cast the column to long type from source data type - NUMERIC/SNUMERIC"
MSG_DECIMAL = "Failed to cast the column to decimal from source data type - AMOUNT"
MSG_RATE_PCT = "Failed to cast the column to float from source data type - rate where source field is expected to be populated with %"
MSG_RATE = "Failed to cast the column to float from source data type - rate"
MARKER_COUNT = r":\s*([0-9]+)"
BLANKS = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
UNDERSCORED = "[0-9]+(_[0-9]+)*"
INTEGER = rf"^\s*-?{UNDERSCORED}\s*$"
DECIMAL = r"^-?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?$"
FLOAT = rf"^\s*[-+]?({UNDERSCORED}(\.({UNDERSCORED})?)?|\.{UNDERSCORED})([eE][-+]?{UNDERSCORED})?\s*$"
FLOAT_WORD = r"(?i)^\s*([-+]?)(infinity|inf|nan)\s*$"
_M, _D = "(1[0-2]|0[1-9]|[1-9])", "(3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])"
# date pattern -> regex and the groups of year, month and day
DATE_TEXT = {
    "YYYYMMDD": (f"^([0-9]{{4}}){_M}{_D}$", 1, 2, 3),
    "DD/MM/YYYY": (f"^{_D}/{_M}/([0-9]{{4}})$", 3, 2, 1),
    "YYYY-MM-DD": (f"^([0-9]{{4}})-{_M}-{_D}$", 1, 2, 3),
}


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"trim({x}, {BLANKS})"


def squeeze(x: str) -> str:
    return f"regexp_replace({x}, '[_\\s]', '', 'g')"


def clean_number(v: str) -> str:
    no_plus = f"replace({v}, '+', '')"
    s = f"ltrim({strip(no_plus)}, '0')"
    s = f"regexp_replace({s}, '^\\.', '0.')"
    s = f"regexp_replace({s}, '^([^.]*)\\.$', '\\1.00')"
    return f"coalesce(nullif({s}, ''), '0')"


def long_of(s: str) -> str:
    return f"CASE WHEN regexp_matches({s}, {q(INTEGER)}) THEN TRY_CAST({squeeze(s)} AS BIGINT) END"


def decimal_of(s: str) -> str:
    plain = f"replace({strip(s)}, '_', '')"
    return (f"CASE WHEN regexp_matches({plain}, {q(DECIMAL)}) "
            f"THEN TRY_CAST({plain} AS DECIMAL(38,18)) END")


def float_of(t: str) -> str:
    sp = q(FLOAT_WORD)
    return (f"CASE WHEN regexp_matches({t}, {sp}) THEN "
            f"(CASE WHEN lower(regexp_extract({t}, {sp}, 2)) = 'nan' THEN 'nan'::DOUBLE "
            f"WHEN regexp_extract({t}, {sp}, 1) = '-' THEN '-inf'::DOUBLE ELSE 'inf'::DOUBLE END) "
            f"WHEN regexp_matches({t}, {q(FLOAT)}) THEN TRY_CAST({squeeze(t)} AS DOUBLE) END")


def rate_parsed(v: str) -> str:
    return (f"(CASE WHEN contains({v}, '%') THEN ({float_of(f'trim({v}, {q(chr(37))})')}) / 100.0 "
            f"ELSE ({float_of(v)}) END)")


def date_parsed(v: str, pattern: str) -> str:
    rx, *groups = DATE_TEXT[pattern.upper()]
    y, m, d = (f"regexp_extract({v}, {q(rx)}, {g})" for g in groups)
    return (f"(CASE WHEN regexp_matches({v}, {q(rx)}) AND {y} <> '0000' THEN "
            f"TRY_CAST(printf('%04d-%02d-%02d', TRY_CAST({y} AS INTEGER), TRY_CAST({m} AS INTEGER), "
            f"TRY_CAST(trim({d}) AS INTEGER)) AS DATE) END)")


def date_value(v: str, parsed: str) -> str:
    return (f"CASE WHEN {v} IN ('', '00000000') OR {parsed} IS NULL "
            f"OR {parsed} < DATE '1582-10-15' THEN DATE '1901-01-01' ELSE {parsed} END")


def date_bad(v: str, parsed: str) -> str:
    return f"(NOT ({v} IN ('', '00000000')) AND {parsed} IS NULL)"


def base_name(p: str) -> str:
    return f"string_split({p}, '/')[-1]"


# --- record input (FIXTURES §3 in DuckDB form) -------------------------------------

RAW_SQL = """
SELECT '/in/LI.' || CASE WHEN l_linestatus = 'O' THEN 'AU_' ELSE 'NZ_' END
         || l_returnflag || '_20240101.TXT' AS file_path,
       CASE WHEN l_orderkey % 37 = 0 THEN substr(line, 1, 53) ELSE line END AS value
FROM (
  SELECT *,
    lpad(cast(l_orderkey AS string), 10, '0') || lpad(cast(l_linenumber AS string), 2, '0')
    || CASE WHEN l_orderkey % 13 = 0 THEN '00000000'
            WHEN l_orderkey % 17 = 0 THEN '20231345'
            WHEN l_orderkey % 41 = 0 THEN '15001010'
            ELSE strftime(l_shipdate, '%Y%m%d') END
    || CASE WHEN l_orderkey % 19 = 0 THEN '12A   '
            ELSE '+' || lpad(cast(cast(l_quantity AS int) AS string), 5, '0') END
    || CASE WHEN l_orderkey % 23 = 0 THEN '     12,345.00'
            ELSE lpad(printf('%.2f', l_extendedprice), 14, '0') END
    || CASE WHEN l_orderkey % 29 = 0 THEN 'x%    '
            WHEN l_orderkey % 31 = 0 THEN 'abc   '
            WHEN l_linenumber % 2 = 0 THEN rpad(printf('%.0f', l_discount * 100) || '%', 6, ' ')
            ELSE rpad(printf('%.2f', l_discount), 6, ' ') END
    || rpad(l_returnflag, 3, ' ') || 'ZZZZZ' AS line
  FROM lineitem) t
"""


def converted_cte(raw: str = "raw", good_only: bool = True) -> str:
    """CTEs ``f`` (stripped fields) and ``c`` (typed values, bad flags, key) over ``raw``."""
    where = f"WHERE length(value) = {RECORD_LENGTH}" if good_only else ""
    fields = ", ".join(f"{strip(f'substr(value, {c.offset + 1}, {c.length})')} AS f{c.position}"
                       for c in FIELDS)
    sel, keys = [], []
    for c in FIELDS:
        f = f"f{c.position}"
        if c.datatype in ("numeric", "snumeric"):
            s = clean_number(f)
            sel += [f"{s} AS t{c.position}", f"{long_of(s)} AS p{c.position}"]
        elif c.datatype == "amount":
            s = clean_number(f)
            sel += [f"{s} AS t{c.position}", f"{decimal_of(s)} AS p{c.position}"]
        elif c.datatype == "date":
            sel += [f"{f} AS t{c.position}", f"{date_parsed(f, 'YYYYMMDD')} AS p{c.position}"]
        elif c.datatype == "rate":
            sel += [f"{f} AS t{c.position}", f"{rate_parsed(f)} AS p{c.position}"]
        else:
            sel += [f"{f} AS t{c.position}"]
    return (f"f AS (SELECT file_path, {fields} FROM {raw} {where}),\n"
            f"c AS (SELECT file_path, {', '.join(f'f{c.position}' for c in FIELDS)}, "
            f"{', '.join(sel)} FROM f)")


def typed_select() -> tuple[list[str], list[tuple[str, str, str, str]], str]:
    """Typed value expressions, (name, bad, text, message) per error column, and the key."""
    vals, errs, key_parts = [], [], []
    for c in FIELDS:
        t, p, f = f"t{c.position}", f"p{c.position}", f"f{c.position}"
        if c.datatype in ("numeric", "snumeric"):
            v = f"coalesce({p}, 0)"
            errs.append((c.name, f"{p} IS NULL", t, q(MSG_LONG)))
        elif c.datatype == "amount":
            v = f"coalesce({p}, CAST(0 AS DECIMAL(38,18)))"
            errs.append((c.name, f"{p} IS NULL", t, q(MSG_DECIMAL)))
        elif c.datatype == "date":
            v = date_value(f, p)
            errs.append((c.name, date_bad(f, p), t, q(MSG_DATE)))
        elif c.datatype == "rate":
            v = f"CAST(coalesce({p}, 0.0) AS FLOAT)"
            msg = f"CASE WHEN contains({f}, '%') THEN {q(MSG_RATE_PCT)} ELSE {q(MSG_RATE)} END"
            errs.append((c.name, f"{p} IS NULL", t, msg))
        else:
            v = t
        vals.append(f"{v} AS {c.name}")
        if c.is_key:
            key_parts.append(f"'{c.name}=' || CAST({v} AS VARCHAR)")
    key = " || '|' || ".join(key_parts) if key_parts else "''"
    return vals, errs, key


def fw_typed_rows_sql() -> str:
    vals, _, _ = typed_select()
    return (f"WITH raw AS ({RAW_SQL}), {converted_cte()}\n"
            f"SELECT {', '.join(vals)}, file_path AS dataops_file_name_path, "
            f"CASE WHEN contains(file_path, '.AU_') THEN 'AU' ELSE 'NZ' END AS dataops_li_region FROM c")


def exceptions_cte() -> str:
    vals, errs, key = typed_select()
    n = EXCEPTION_COLUMNS
    parts = [f"SELECT {base_name('file_path')} AS {n[0]}, key AS {n[1]}, {q(LINEITEM_TABLE)} AS {n[2]}, "
             f"{q(name)} AS {n[3]}, {text} AS {n[4]}, {msg} AS {n[5]}, 'N' AS {n[6]}, '' AS {n[7]}, "
             f"file_path FROM k WHERE {bad}"
             for name, bad, text, msg in errs]
    any_bad = " OR ".join(f"({bad})" for _, bad, _, _ in errs) or "false"
    return (f"raw AS ({RAW_SQL}), {converted_cte()},\n"
            f"k AS (SELECT *, {key} AS key, {any_bad} AS any_bad FROM (SELECT *, {', '.join(vals)} FROM c)),\n"
            f"e AS ({' UNION ALL '.join(parts)})")


def fw_exceptions_sql() -> str:
    cols = ", ".join(EXCEPTION_COLUMNS)
    return f"WITH {exceptions_cte()} SELECT {cols} FROM e"


def fw_width_rejects_sql() -> str:
    return (f"WITH raw AS ({RAW_SQL}) SELECT value, file_path FROM raw "
            f"WHERE length(value) <> {RECORD_LENGTH}")


def region_sql(three_way: bool) -> str:
    vals, _, _ = typed_select()
    raw = f"SELECT replace(file_path, '.NZ_A_', '.XX_A_') AS file_path, value FROM ({RAW_SQL})"
    region = ("CASE WHEN contains(file_path, '.AU_') THEN 'AU' WHEN contains(file_path, '.NZ_') THEN 'NZ' ELSE '' END"
              if three_way else "CASE WHEN contains(file_path, '.AU_') THEN 'AU' ELSE 'NZ' END")
    return (f"WITH raw AS ({raw}), {converted_cte()}\n"
            f"SELECT ORDER_KEY, LINE_NO, file_path, region FROM "
            f"(SELECT {', '.join(vals)}, file_path, {region} AS region FROM c)")


def per_file_cte() -> str:
    n = RECORD_LENGTH
    return (f"{exceptions_cte()},\n"
            f"pf AS (SELECT file_path, count(*) AS raw_count, "
            f"count(*) FILTER (WHERE length(value) = {n}) AS loaded_count FROM raw GROUP BY file_path),\n"
            f"dq AS (SELECT file_path, count(DISTINCT {EXCEPTION_COLUMNS[1]}) AS dq_count, "
            f"count(*) AS n_errors FROM e GROUP BY file_path)")


def fw_counts_sql() -> str:
    return (f"WITH {per_file_cte()},\n"
            "rowsx AS (SELECT count(*) FILTER (WHERE any_bad) AS failing FROM k),\n"
            "errs AS (SELECT count(*) AS n FROM e)\n"
            "SELECT CAST(sum(raw_count) AS BIGINT) AS raw_count, CAST(sum(loaded_count) AS BIGINT) AS loaded_count, "
            "CAST(sum(raw_count - loaded_count) AS BIGINT) AS rejected_count, "
            "CAST((SELECT n FROM errs) AS BIGINT) AS dq_error_count, "
            "CAST((SELECT failing FROM rowsx) AS BIGINT) AS dq_row_count, "
            "CAST(count(*) FILTER (WHERE raw_count > 0) AS BIGINT) AS files_with_rows, "
            "CAST(count(*) AS BIGINT) AS number_of_source_files FROM pf")


def fw_rows_per_file_sql() -> str:
    return f"WITH raw AS ({RAW_SQL}) SELECT file_path, count(*) AS raw_count FROM raw GROUP BY file_path ORDER BY 1"


def fw_good_per_file_sql() -> str:
    n = RECORD_LENGTH
    return (f"WITH raw AS ({RAW_SQL}) SELECT file_path, count(*) FILTER (WHERE length(value) = {n}) "
            f"AS loaded_count FROM raw GROUP BY file_path ORDER BY 1")


def fw_dq_per_file_sql() -> str:
    return (f"WITH {exceptions_cte()} SELECT {base_name('file_path')} AS file_name, "
            f"count(DISTINCT {EXCEPTION_COLUMNS[1]}) AS dq_count FROM e GROUP BY file_path ORDER BY 1")


def fw_base_name_sql() -> str:
    return (f"WITH raw AS ({RAW_SQL}) SELECT {base_name('file_path')} AS file_name, count(*) AS line_count "
            f"FROM raw GROUP BY 1")


def fw_layout_sql() -> str:
    filler = f"SELECT 7 AS position, 'FILLERS' AS column_name, 'string' AS column_datatype, 49 AS offset, 5 AS column_length, false AS is_key, " \
             f"{RECORD_LENGTH} AS record_length, NULL AS records, NULL AS least, NULL AS most"
    parts = [f"SELECT {c.position} AS position, {q(c.name)} AS column_name, {q(c.datatype)} AS column_datatype, {c.offset} AS offset, "
             f"{c.length} AS column_length, {str(c.is_key).lower()} AS is_key, {RECORD_LENGTH} AS record_length, count(*) AS records, "
             f"min(substr(value, {c.offset + 1}, {c.length})) AS least, max(substr(value, {c.offset + 1}, {c.length})) AS most "
             f"FROM raw WHERE length(value) = {RECORD_LENGTH}" for c in FIELDS]
    return f"WITH raw AS ({RAW_SQL}) " + " UNION ALL ".join([*parts, filler])


def fw_layout_as_of_sql() -> str:
    return """
WITH d AS (SELECT DISTINCT strftime(o_orderdate, '%Y%m%d') AS d FROM orders),
names AS (
  SELECT DISTINCT file_path FROM (
    SELECT '/layouts/LI_LAYOUT_' || d || '.csv' AS file_path FROM d
    UNION ALL SELECT '/layouts/LX_LAYOUT_' || d || '.csv' FROM d
    UNION ALL SELECT '/layouts/LI_LAYOUT_' || substr(d, 1, 4) || '13' || substr(d, 7, 2) || '.csv' FROM d)),
dated AS (
  SELECT file_path, string_split(file_path, '/')[-1] AS name,
         regexp_extract(string_split(file_path, '/')[-1], '([0-9]{8})', 1) AS ds FROM names),
typed AS (
  SELECT file_path, name,
         TRY_CAST(substr(ds, 1, 4) || '-' || substr(ds, 5, 2) || '-' || substr(ds, 7, 2) AS DATE) AS layout_date
  FROM dated WHERE length(ds) = 8)
SELECT file_path, layout_date FROM typed
WHERE starts_with(name, 'LI') AND layout_date <= DATE '1996-01-01'
ORDER BY layout_date DESC, file_path LIMIT 1
"""


def marker_cte() -> str:
    return (f"ml AS (SELECT {base_name('file_path')} AS name, "
            f"{base_name('file_path')} || ': ' || CAST(raw_count AS VARCHAR) AS line_content FROM pf),\n"
            f"mk AS (SELECT row_number() OVER (ORDER BY name) AS line_number, line_content, "
            f"TRY_CAST(regexp_extract(line_content, {q(MARKER_COUNT)}, 1) AS BIGINT) AS count FROM ml)")


def fw_marker_counts_sql() -> str:
    return f"WITH {per_file_cte()},\n{marker_cte()} SELECT line_number, line_content, count FROM mk ORDER BY 1"


def summary_sql(marker: bool) -> str:
    order_date = datetime.datetime.strptime(qs.ORDER_DATE, "%Y%m%d").strftime("%Y-%m-%d")
    base = ("b AS (SELECT pf.file_path, " + base_name("pf.file_path") + " AS file_name, raw_count, "
            "loaded_count AS loaded, coalesce(dq.dq_count, 0) AS dq, count(*) OVER () AS n_files, "
            "row_number() OVER (ORDER BY " + base_name("pf.file_path") + ", pf.file_path) AS ordinal "
            "FROM pf LEFT JOIN dq ON pf.file_path = dq.file_path)")
    if marker:
        src = "mk.count"
        rej = "mk.count - loaded"
        frm = "b JOIN mk ON b.ordinal = mk.line_number"
    else:
        src = "NULL"
        rej = "sum(raw_count - loaded) OVER ()"
        frm = "b"
    return (f"WITH {per_file_cte()},\n{marker_cte()},\n{base}\n"
            f"SELECT {q(LINEITEM_TABLE)} AS table_name, file_name, {q(order_date)} AS order_date, "
            f"{q(qs.JOB_RUN_DATE)} AS job_run_date, CAST({src} AS BIGINT) AS source_file_record_count, "
            f"CAST({rej} AS BIGINT) AS record_length_rejection_count, "
            f"CAST(loaded AS BIGINT) AS total_records_loaded_count, "
            f"CAST(loaded - dq AS BIGINT) AS clean_record_count, CAST(dq AS BIGINT) AS data_quality_issue_count, "
            f"CAST(n_files AS BIGINT) AS number_of_source_files FROM {frm} ORDER BY file_name")


# --- scalar-rule queries ---------------------------------------------------------------

def _date_texts_sql() -> str:
    ymd = "strftime(l_shipdate, '%Y%m%d')"
    return f"""
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_orderkey % 13 = 0 THEN '00000000' WHEN l_orderkey % 11 = 0 THEN ''
       WHEN l_orderkey % 17 = 0 THEN substr({ymd}, 1, 4) || '13' || substr({ymd}, 7, 2)
       WHEN l_orderkey % 41 = 0 THEN '1500' || substr({ymd}, 5, 4)
       ELSE {ymd} END AS text_compact,
  CAST(year(l_shipdate) AS VARCHAR) || CAST(month(l_shipdate) AS VARCHAR) || CAST(day(l_shipdate) AS VARCHAR)
    AS text_unpadded,
  CASE WHEN l_orderkey % 7 = 0 THEN '31/' || strftime(l_shipdate, '%m/%Y')
       ELSE strftime(l_shipdate, '%d/%m/%Y') END AS text_dmy,
  CASE WHEN l_orderkey % 5 = 0 THEN replace(strftime(l_shipdate, '%Y-%m-%d'), '-0', '- ')
       ELSE strftime(l_shipdate, '%Y-%m-%d') END AS text_iso
FROM lineitem"""


def fw_date_variants_sql() -> str:
    cols = ["l_orderkey", "l_linenumber"]
    for name, pattern in qs.DATE_VARIANTS:
        v = strip(f"text_{name}")
        p = date_parsed(v, pattern)
        cols += [f"{date_value(v, p)} AS date_{name}", f"{date_bad(v, p)} AS bad_{name}"]
    return f"SELECT {', '.join(cols)} FROM ({_date_texts_sql()})"


def fw_number_clean_sql() -> str:
    price = "printf('%.2f', l_extendedprice)"
    qty = "CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)"
    texts = f"""
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_orderkey % 19 = 0 THEN '12A' WHEN l_orderkey % 7 = 0 THEN '-00' || {qty}
       WHEN l_orderkey % 11 = 0 THEN '1_' || {qty} WHEN l_orderkey % 13 = 0 THEN '000'
       WHEN l_orderkey % 17 = 0 THEN '+' ELSE '+' || lpad({qty}, 5, '0') END AS text_qty,
  CASE WHEN l_orderkey % 23 = 0 THEN '12,345.00' WHEN l_orderkey % 7 = 0 THEN '.' || split_part({price}, '.', 2)
       WHEN l_orderkey % 11 = 0 THEN split_part({price}, '.', 1) || '.' WHEN l_orderkey % 13 = 0 THEN ''
       WHEN l_orderkey % 17 = 0 THEN {qty} || 'E' || CAST(l_linenumber AS VARCHAR)
       WHEN l_orderkey % 29 = 0 THEN '00' || {price} || '.5' WHEN l_orderkey % 31 = 0 THEN '-' || {price}
       ELSE '+' || lpad({price}, 13, '0') END AS text_price
FROM lineitem"""
    sq, sp = clean_number(strip("text_qty")), clean_number(strip("text_price"))
    return (f"SELECT l_orderkey, l_linenumber, cq AS clean_qty, coalesce(pq, 0) AS qty, pq IS NULL AS bad_qty, "
            f"cp AS clean_price, coalesce(pp, CAST(0 AS DECIMAL(38,18))) AS price, pp IS NULL AS bad_price FROM "
            f"(SELECT *, {long_of('cq')} AS pq, {decimal_of('cp')} AS pp FROM "
            f"(SELECT l_orderkey, l_linenumber, {sq} AS cq, {sp} AS cp FROM ({texts})))")


def fw_rate_sql() -> str:
    texts = """
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_orderkey % 29 = 0 THEN 'x%' WHEN l_orderkey % 31 = 0 THEN 'abc' WHEN l_orderkey % 13 = 0 THEN ''
       WHEN l_orderkey % 11 = 0 THEN '%' WHEN l_orderkey % 7 = 0 THEN printf('%.0f', l_tax * 100) || '%%'
       WHEN l_linenumber % 2 = 0 THEN printf('%.0f', l_discount * 100) || '%'
       ELSE printf('%.2f', l_discount) END AS text_rate
FROM lineitem"""
    v = strip("text_rate")
    return (f"SELECT l_orderkey, l_linenumber, text_rate, CAST(coalesce(p, 0.0) AS FLOAT) AS rate, "
            f"p IS NULL AS bad_rate, CASE WHEN p IS NULL THEN (CASE WHEN contains(v, '%') "
            f"THEN {q(MSG_RATE_PCT)} ELSE {q(MSG_RATE)} END) END AS error_message FROM "
            f"(SELECT *, {rate_parsed('v')} AS p FROM (SELECT *, {v} AS v FROM ({texts})))")


# --- masking -------------------------------------------------------------------------

CUST_SQL = "SELECT " + ", ".join(f"{sql} AS {name}" for name, sql in CONTACT_SQL.items()) + " FROM customer"


def key_hash(salt: str, *parts: str, literal: tuple[bool, ...] = ()) -> str:
    cols = []
    for i, p in enumerate(parts):
        is_lit = literal[i] if i < len(literal) else False
        cols.append(q(p) if is_lit else f"coalesce(CAST({p} AS VARCHAR), '')")
    return f"md5(concat_ws(chr(31), {q(salt)}, {', '.join(cols)}))"


def draw32(h: str, i: int) -> str:
    return f"('0x' || substr({h}, {1 + 8 * i}, 8))::BIGINT"


def draw60(h: str) -> str:
    return f"('0x' || substr({h}, 1, 15))::BIGINT"


def pick(words: tuple[str, ...], n: str) -> str:
    return f"([{', '.join(q(w) for w in words)}])[({n}) % {len(words)} + 1]"


def g_first(h: str, gender: str | None = None, fixed: str | None = None) -> str:
    anyone = pick(vocab.FEMALE_FIRST_NAMES + vocab.MALE_FIRST_NAMES, draw32(h, 0))
    female = pick(vocab.FEMALE_FIRST_NAMES, draw32(h, 0))
    male = pick(vocab.MALE_FIRST_NAMES, draw32(h, 0))
    if fixed is not None:
        return female if fixed == "F" else male
    if gender is None:
        return anyone
    return f"CASE WHEN {gender} IS NULL THEN {anyone} WHEN {gender} = 'F' THEN {female} ELSE {male} END"


def g_email(h: str) -> str:
    first = pick(vocab.FEMALE_FIRST_NAMES + vocab.MALE_FIRST_NAMES, draw32(h, 0))
    return (f"lower({first}) || '.' || lower({pick(vocab.LAST_NAMES, draw32(h, 1))}) || "
            f"CAST({draw32(h, 2)} % 100 AS VARCHAR) || '@' || {pick(vocab.EMAIL_DOMAINS, draw32(h, 3))}")


def g_phone(h: str) -> str:
    d = f"lpad(CAST({draw60(h)} % 100000000 AS VARCHAR), 8, '0')"
    return f"'04' || substr({d}, 1, 2) || ' ' || substr({d}, 3, 3) || ' ' || substr({d}, 6, 3)"


def generator_sql(type_name: str, h: str, meta_col: str | None = None) -> str:
    if type_name == "firstname":
        return g_first(h, meta_col)
    if type_name == "lastname":
        return pick(vocab.LAST_NAMES, draw32(h, 1))
    if type_name == "date_of_birth":
        lo = datetime.date(2000, 1, 1)
        days = (datetime.date(2005, 12, 31) - lo).days + 1
        return f"strftime(DATE '{lo}' + CAST({draw60(h)} % {days} AS INTEGER), '%Y-%m-%d %H:%M:%S')"
    if type_name == "street_number":
        return f"CAST({draw32(h, 2)} % 1400 + 1 AS VARCHAR)"
    if type_name == "street_name":
        return pick(vocab.STREET_NAMES, draw32(h, 3))
    if type_name == "street_suffix":
        return pick(vocab.STREET_SUFFIXES, draw32(h, 2))
    if type_name == "city":
        return pick(vocab.CITIES, draw32(h, 1))
    if type_name == "state":
        return pick(vocab.STATES, draw32(h, 0))
    if type_name == "zip_code":
        return f"lpad(CAST({draw32(h, 3)} % 10000 AS VARCHAR), 4, '0')"
    if type_name == "email":
        return g_email(h)
    if type_name == "phone_number":
        return g_phone(h)
    if type_name == "contact_details":
        t = f"lower({meta_col})"
        return (f"CASE WHEN contains({t}, 'email') THEN {g_email(h)} "
                f"WHEN contains({t}, 'phone') THEN {g_phone(h)} END")
    if type_name == "account_number":
        lo, hi = 1000000000100000, 1200000000000000
        return f"CAST({lo} + {draw60(h)} % {hi - lo + 1} AS VARCHAR)"
    if type_name == "drivers_license":
        a = q(vocab.ALPHABET)
        return (f"substr({a}, CAST({draw32(h, 0)} % 26 + 1 AS INTEGER), 1) || "
                f"substr({a}, CAST({draw32(h, 1)} % 26 + 1 AS INTEGER), 1) || "
                f"CAST({draw32(h, 2)} % 9000 + 1000 AS VARCHAR)")
    raise ValueError(type_name)


# What the masking must go by, written out here as well.
META_KEYS = {"firstname": "gender_column_name", "lastname": "gender_column_name", "contact_details": "contact_type_column_name"}
EMAIL_SHAPE, PHONE_SHAPE = r"^[^@]+@[^@]+\.[^@]+", r"^[\s0-9]+"
LOOKUP_SEP = "#~"
# column -> per provider: shape, function, arguments as text, gender; then the lookup columns and their joined names
KEYED = {
    "contact_value": ((("Email", "email", "{}", None), ("Phone", "phone_number", "{}", None), ("All", "firstname", "{}", None)), ("cust_id",), "cust_id"),
    "full_name": ((("All", "firstname", '{"gender":"female"}', "F"),), ("gender",), "gender"),
}


def _type_expr(column: str, cfg: dict) -> str:
    type_name = cfg["type"]
    meta = cfg.get("meta") or {}
    meta_col = meta.get(META_KEYS.get(type_name))
    h = key_hash(qs.MASK_SALT, type_name, column, column, literal=(True, True, False))
    return generator_sql(type_name, f"h_{column}", meta_col), f"{h} AS h_{column}"


def mask_type_sql(type_name: str) -> str:
    column, cfg = qs.MASK_TYPE_TARGETS[type_name]
    expr, h = _type_expr(column, cfg)
    return f"SELECT cust_id, {expr} AS masked FROM (SELECT *, {h} FROM ({CUST_SQL}))"


def mask_config_sql() -> str:
    cols = [c for c in CONTACT_COLUMNS]
    exprs, hashes = {}, []
    for column, cfg in qs.MASK_CONFIG.items():
        e, h = _type_expr(column, cfg)
        exprs[column] = e
        hashes.append(h)
    sel = ", ".join(f"{exprs.get(c, c)} AS {c}" for c in cols)
    return f"SELECT {sel} FROM (SELECT *, {', '.join(hashes)} FROM ({CUST_SQL}))"


def _keyed_expr(column: str) -> tuple[str, list[str]]:
    providers, lookups, names = KEYED[column]
    values = f"concat_ws({q(LOOKUP_SEP)}, {', '.join(f"coalesce({c}, '')" for c in lookups)})"
    hashes, cases = [], []
    for i, (shape, function, arguments, gender) in enumerate(providers):
        h = f"h_{column}_{i}"
        hashes.append(f"md5(concat_ws(chr(31), {q(qs.MASK_SALT)}, {q(function)}, {q(arguments)}, {q(column)}, coalesce({column}, ''), "
                      f"{q(names)}, {values})) AS {h}")
        out = g_first(h, fixed=gender) if function == "firstname" else generator_sql(function, h)
        test = {"Email": f"regexp_matches({column}, {q(EMAIL_SHAPE)})", "Phone": f"regexp_matches({column}, {q(PHONE_SHAPE)})", "All": "true"}[shape]
        cases.append(f"WHEN {test} THEN {out}")
    return f"CASE WHEN {column} IS NULL OR {column} = '' THEN {column} ELSE (CASE {' '.join(cases)} END) END", hashes


def mask_keyed_sql(source: str | None = None) -> str:
    source = source or CUST_SQL
    exprs, hashes = {}, []
    for column in KEYED:
        e, h = _keyed_expr(column)
        exprs[column] = e
        hashes += h
    sel = ", ".join(f"{exprs.get(c, c)} AS {c}" for c in CONTACT_COLUMNS)
    return f"SELECT {sel} FROM (SELECT *, {', '.join(hashes)} FROM ({source}))"


# Written to delimited files and read back, a null field comes back as ''.
CUST_FILE_SQL = ("SELECT " + ", ".join(f"coalesce({c}, '') AS {c}" for c in CONTACT_COLUMNS)
                 + f" FROM ({CUST_SQL})")


# --- functions of keyed masking with arguments ----------------------------------------

def _later(h: str, i: int) -> str:
    """The i-th 32-bit number of a key's hash and the digests after it."""
    digest = h if i < 4 else f"md5({h} || ':{i // 4}')"
    return f"('0x' || substr({digest}, {1 + 8 * (i % 4)}, 8))::BIGINT"


def _char(chars: str, h: str, i: int) -> str:
    return f"substr({q(chars)}, CAST({_later(h, i)} % {len(chars)} + 1 AS INTEGER), 1)"


DIGITS, SMALL, CAPITALS = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _digits(h: str, *places: int) -> str:
    return " || ".join(_char(DIGITS, h, i) for i in places)


def mask_function_sqls() -> dict[str, str]:
    """One query each, the templates and argument texts written out."""
    h = "h"
    anyone = vocab.FEMALE_FIRST_NAMES + vocab.MALE_FIRST_NAMES
    first = pick(anyone, draw32("md5(h || '/0')", 0))
    domains = ("corp.example", "mail.corp.example", "post.example")
    cases = {
        "mask_phone_template": ("contact_value", "phone_number", '{"mask":"+61 4## ### ###"}',
                                f"'+61 4' || {_digits(h, 1, 2)} || ' ' || {_digits(h, 4, 5, 6)} || ' ' || {_digits(h, 8, 9, 10)}"),
        "mask_mail_domains": ("contact_value", "email", '{"domains":["corp.example","@mail.corp.example","post.example"]}',
                              f"lower({pick(anyone, draw32(h, 0))}) || '.' || lower({pick(vocab.LAST_NAMES, draw32(h, 1))}) || "
                              f"CAST({draw32(h, 2)} % 100 AS VARCHAR) || '@' || {pick(domains, draw32(h, 3))}"),
        "mask_full_name": ("full_name", "full_name", '{"gender":"female","reverse":true}',
                           f"{pick(vocab.LAST_NAMES, draw32(h, 1))} || ', ' || {pick(vocab.FEMALE_FIRST_NAMES, draw32(h, 0))}"),
        "mask_address": ("segment", "address", "{}",
                         f"CAST({draw32(h, 2)} % 1400 + 1 AS VARCHAR) || ' ' || {pick(vocab.STREET_NAMES, draw32(h, 3))} || ' ' || "
                         f"{pick(vocab.STREET_SUFFIXES, draw32('md5(h)', 2))}"),
        "mask_user_name": ("full_name", "user_name", '{"mask":"{firstname}_[a|bc|d][7-12]"}',
                           f"lower({first} || '_' || {pick(('a', 'bc', 'd'), _later(h, 2))} || CAST(7 + {_later(h, 3)} % 6 AS VARCHAR))"),
        "mask_code_template": ("contact_value", "template", r'{"template":"@@-####-??\\#"}',
                               f"{_char(CAPITALS, h, 0)} || {_char(CAPITALS, h, 1)} || '-' || {_digits(h, 3, 4, 5, 6)} || '-' || "
                               f"{_char(SMALL, h, 8)} || {_char(SMALL, h, 9)} || '#'"),
    }
    out = {}
    for name, (column, function, arguments, value) in cases.items():
        key = f"md5(concat_ws(chr(31), {q(qs.MASK_SALT)}, {q(function)}, {q(arguments)}, {q(column)}, coalesce({column}, ''), '', ''))"
        out[name] = (f"SELECT cust_id, CASE WHEN {column} IS NULL OR {column} = '' THEN {column} ELSE {value} END AS masked "
                     f"FROM (SELECT *, {key} AS h FROM ({CUST_SQL}))")
    return out


def mask_distinct_number_sql() -> str:
    """Four half rounds over two digits, and again for a number beyond the range."""
    start, size = 1000000000100000, 1200000000000000 - 1000000000100000 + 1
    width = math.isqrt(size - 1) + 1
    height = -(-size // width)
    key = f"{qs.MASK_SALT}/distinct_number/{{}}/cust_id"

    def drawn(k: int, digit: str, base: int) -> str:
        return f"(('0x' || substr(md5({q(f'{key}:{k}:')} || {digit}), 1, 15))::BIGINT % {base})"

    def passed(x: str, source: str) -> str:
        sql = f"SELECT *, {x} // {width} AS l, {x} % {width} AS r FROM ({source})"
        for k in range(4):
            change = f"(r + {drawn(k, 'l', width)}) % {width} AS r" if k % 2 else f"(l + {drawn(k, 'r', height)}) % {height} AS l"
            sql = f"SELECT * REPLACE ({change}) FROM ({sql})"
        return f"SELECT * EXCLUDE (l, r), l * {width} + r AS y FROM ({sql})"

    one = passed("x", f"SELECT cust_id, CAST(cust_id AS BIGINT) AS x FROM ({CUST_SQL})")
    two = passed("x", f"SELECT cust_id, y AS first, y AS x FROM ({one})")
    return f"SELECT cust_id, CAST({start} + CASE WHEN first < {size} THEN first ELSE y END AS VARCHAR) AS masked FROM ({two})"


CONFIG_PROBLEMS_SQL = """
WITH e AS (SELECT s_name AS t, CASE s_suppkey % 3 WHEN 0 THEN 'city' WHEN 1 THEN 'contact_details' ELSE 'kind' || (s_suppkey % 5) END AS type,
                  CASE s_suppkey % 4 WHEN 1 THEN 'contact_type' WHEN 2 THEN 'no_' || s_suppkey END AS meta FROM supplier)
SELECT '''' || t || ''' needs column ''' || t || ''', which the table lacks' AS problem FROM e
UNION ALL SELECT '''' || t || ''' needs column ''' || meta || ''', which the table lacks' FROM e WHERE meta <> 'contact_type'
UNION ALL SELECT '''' || t || ''' has the unknown mask type ''' || type || '''' FROM e WHERE type LIKE 'kind%'
UNION ALL SELECT '''' || t || ''' needs meta ''contact_type_column_name''' FROM e WHERE type = 'contact_details' AND meta IS NULL
"""


# --- fixed-width: wide layouts, switches, runs, marker numbers ---------------------------

CLEAN = " AND ".join(f"CAST(substr(value, 1, 10) AS BIGINT) % {n} <> 0" for n in (13, 17, 41, 19, 23, 29, 31, 37))
CLEAN_RAW = f"SELECT * FROM ({RAW_SQL}) WHERE {CLEAN}"
COPIES = 8


def fw_wide_rows_sql() -> str:
    columns = [f"{c.name} AS {c.name}_{k}" for k in range(COPIES) for c in FIELDS]
    return f"SELECT {', '.join(columns)}, dataops_file_name_path, dataops_li_region FROM ({fw_typed_rows_sql()})"


def fw_wide_exceptions_sql() -> str:
    key = "replace(replace(row_business_key, 'ORDER_KEY=', 'ORDER_KEY_0='), 'LINE_NO=', 'LINE_NO_0=')"
    return (f"SELECT * EXCLUDE (k) REPLACE ({key} AS row_business_key, column_name || '_' || k AS column_name) "
            f"FROM ({fw_exceptions_sql()}), range({COPIES}) AS t(k)")


def fw_exception_names_sql() -> str:
    names = ("src_file", "row_key", "tbl", "col", "val", "msg", "fixed", "fixed_at")
    return f"SELECT {', '.join(f'{a} AS {b}' for a, b in zip(EXCEPTION_COLUMNS, names, strict=True))} FROM ({fw_exceptions_sql()})"


def fw_join_counts_sql() -> str:
    both = f"{RAW_SQL} UNION ALL SELECT replace(file_path, '/LI.', '/LI.CLEAN.') AS file_path, value FROM ({CLEAN_RAW})"
    return (f"WITH {per_file_cte().replace(RAW_SQL, both)},\n"
            f"s AS (SELECT {base_name('pf.file_path')} AS file_name, raw_count, loaded_count, coalesce(dq_count, 0) AS dq FROM pf LEFT JOIN dq USING (file_path) "
            f"UNION ALL SELECT {base_name('file_path')} || '.EMPTY', 0, 0, 0 FROM pf)\n"
            f"SELECT {q(LINEITEM_TABLE)} AS table_name, file_name, '2024-01-01' AS order_date, {q(qs.JOB_RUN_DATE)} AS job_run_date, "
            f"CAST(NULL AS BIGINT) AS source_file_record_count, raw_count - loaded_count AS record_length_rejection_count, "
            f"loaded_count AS total_records_loaded_count, loaded_count - dq AS clean_record_count, dq AS data_quality_issue_count, "
            f"count(*) OVER () AS number_of_source_files FROM s")


MARKER_NUMBERS_SQL = rf"""
WITH m AS (SELECT c_nationkey AS nation, c_custkey,
                  'F' || c_custkey || CASE WHEN c_custkey % 7 = 0 THEN ' none' ELSE ': ' || (c_custkey * 3) END AS line_content
           FROM customer WHERE c_custkey % 25 >= c_nationkey)
SELECT nation, row_number() OVER (PARTITION BY nation ORDER BY c_custkey) AS line_number, line_content,
       TRY_CAST(regexp_extract(line_content, '{MARKER_COUNT}', 1) AS BIGINT) AS count FROM m
"""


def fw_summary_by_name_sql() -> str:
    name = base_name("pf.file_path")
    source = (f"CASE WHEN {name} LIKE '%NZ_R_20240101.TXT' OR {name} LIKE '%NZ_A_20240101.TXT' THEN NULL ELSE raw_count END")
    return (f"WITH {per_file_cte()}\nSELECT {q(LINEITEM_TABLE)} AS table_name, {name} AS file_name, '2024-01-01' AS order_date, "
            f"{q(qs.JOB_RUN_DATE)} AS job_run_date, {source} AS source_file_record_count, {source} - loaded_count AS record_length_rejection_count, "
            f"loaded_count AS total_records_loaded_count, loaded_count - coalesce(dq_count, 0) AS clean_record_count, "
            f"coalesce(dq_count, 0) AS data_quality_issue_count, count(*) OVER () AS number_of_source_files FROM pf LEFT JOIN dq USING (file_path)")


def fw_marker_problems_sql() -> str:
    name = base_name("file_path")
    return (f"WITH f AS (SELECT DISTINCT {name} AS file_name FROM ({RAW_SQL})) "
            "SELECT file_name, 'no marker line' AS problem, 1 AS n_files, 0 AS n_lines FROM f WHERE file_name LIKE '%NZ_R_20240101.TXT' "
            "UNION ALL SELECT file_name, 'several marker lines', 1, 2 FROM f WHERE file_name LIKE '%NZ_A_20240101.TXT' "
            "UNION ALL SELECT 'LI.LOST.TXT', 'no such file', 0, 1 FROM f WHERE file_name LIKE '%NZ_R_20240101.TXT'")


def fw_clean_feed_sql() -> str:
    return (f"SELECT count(*) AS loaded_count, 0 AS exception_count, 0 AS reject_count, 0 AS exception_rows, false AS has_dq_detail, "
            f"false AS has_dq_header, false AS has_rejects FROM ({CLEAN_RAW})")


def fw_second_run_sql() -> str:
    return (f"SELECT 1 AS run, (SELECT count(*) FROM ({fw_typed_rows_sql()})) AS typed_rows, (SELECT count(*) FROM ({fw_exceptions_sql()})) AS exception_rows "
            f"UNION ALL SELECT 2, (SELECT count(*) FROM ({CLEAN_RAW})), 0")


SUMMARY_COLUMNS = ("table_name", "file_name", "order_date", "job_run_date", "source_file_record_count", "record_length_rejection_count",
                   "total_records_loaded_count", "clean_record_count", "data_quality_issue_count", "number_of_source_files")


def fw_job_summary_sql() -> str:
    return (f"WITH {per_file_cte()},\n"
            f"s AS (SELECT {base_name('pf.file_path')} AS file_name, raw_count, loaded_count, coalesce(dq_count, 0) AS dq_count "
            f"FROM pf LEFT JOIN dq USING (file_path) UNION ALL SELECT 'LI.AU_Z_20240101.TXT', 0, 0, 0)\n"
            f"SELECT {q(LINEITEM_TABLE)} AS table_name, file_name, '2024-01-01' AS order_date, {q(qs.JOB_RUN_DATE)} AS job_run_date, "
            f"raw_count AS source_file_record_count, raw_count - loaded_count AS record_length_rejection_count, "
            f"loaded_count AS total_records_loaded_count, loaded_count - dq_count AS clean_record_count, "
            f"dq_count AS data_quality_issue_count, count(*) OVER () AS number_of_source_files, 1 AS csv_rows FROM s")


def fw_job_counts_sql(columns: str) -> str:
    return (f"WITH {per_file_cte()}, t AS (SELECT sum(loaded_count) AS loaded, sum(raw_count - loaded_count) AS rejects FROM pf) "
            f"SELECT 'LINEITEM_FW_LANDED' AS table_name, {columns} FROM t")


def fw_job_headers_sql() -> str:
    rows = [(h, i, name) for h, names in (("dq_header", EXCEPTION_COLUMNS), ("summary_header", SUMMARY_COLUMNS)) for i, name in enumerate(names)]
    return "SELECT * FROM (VALUES " + ", ".join(f"({q(h)}, {i}, {q(n)})" for h, i, n in rows) + ") AS t(header, position, name)"


TARGET_NAMES_SQL = """
WITH n AS (SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'CUST_' || c_custkey || '_20230101.csv' WHEN 1 THEN 'CUST' || c_custkey || '.csv'
                  WHEN 2 THEN 'A_B_' || c_custkey WHEN 3 THEN 'x.y_' || c_custkey || '_z.tar.gz' ELSE 'plain' END AS source_name FROM customer),
p AS (SELECT *, CASE WHEN contains(source_name, '.') THEN '.' || string_split(source_name, '.')[-1] ELSE '' END AS suffix FROM n),
s AS (SELECT *, left(source_name, length(source_name) - length(suffix)) AS stem FROM p)
SELECT c_custkey, source_name, array_to_string(string_split(stem, '_')[:-2], '_') || '_20240101' || suffix AS target_name FROM s
"""


def mask_config_from_file_sql() -> str:
    """Later columns see the masked values of earlier ones: one level each."""
    sql = CUST_SQL
    for column, cfg in qs.MASK_FILE_CONFIG.items():
        expr, h = _type_expr(column, cfg)
        sql = f"SELECT * EXCLUDE (h_{column}) REPLACE ({expr} AS {column}) FROM (SELECT *, {h} FROM ({sql}))"
    return sql


def mask_csv_mixed_headers_sql() -> str:
    note = ("CASE CAST(cust_id AS BIGINT) % 4 WHEN 0 THEN 'say \"' || segment || '\" | x' WHEN 1 THEN '  ' || segment || ' ' "
            "WHEN 2 THEN segment || chr(10) || 'second line' ELSE '' END AS note")
    masked = mask_keyed_sql(CUST_FILE_SQL)
    return f"SELECT cust_id, contact_value, full_name, gender, note FROM ({masked}) JOIN (SELECT cust_id, {note} FROM ({CUST_SQL})) USING (cust_id)"


def registry() -> dict[str, str]:
    out = {
        **mask_function_sqls(),
        "mask_distinct_number": mask_distinct_number_sql(),
        "mask_config_problems": CONFIG_PROBLEMS_SQL,
        "fw_wide_rows": fw_wide_rows_sql(),
        "fw_wide_exceptions": fw_wide_exceptions_sql(),
        "fw_no_path_columns": f"SELECT * EXCLUDE (dataops_file_name_path, dataops_li_region) FROM ({fw_typed_rows_sql()})",
        "fw_exception_names": fw_exception_names_sql(),
        "fw_join_counts": fw_join_counts_sql(),
        "fw_marker_numbers": MARKER_NUMBERS_SQL,
        "fw_summary_by_name": fw_summary_by_name_sql(),
        "fw_marker_problems": fw_marker_problems_sql(),
        "fw_clean_feed": fw_clean_feed_sql(),
        "fw_second_run": fw_second_run_sql(),
        "fw_job_exceptions": fw_exceptions_sql(),
        "fw_job_exceptions_csv": fw_exceptions_sql(),
        "fw_job_rejects": f"SELECT value FROM ({fw_width_rejects_sql()})",
        "fw_job_summary": fw_job_summary_sql(),
        "fw_marker_mismatch": fw_job_counts_sql("CAST(loaded AS BIGINT) AS loaded_count, 0 AS summary_rows"),
        "fw_job_headers": fw_job_headers_sql(),
        "fw_job_manifest": fw_job_counts_sql(
            f"{q(qs.ORDER_DATE)} AS order_date, CAST(loaded AS BIGINT) AS loaded_count, "
            "(SELECT count(*) FROM e) AS exception_count, CAST(rejects AS BIGINT) AS reject_count, CAST(1 AS BIGINT) AS run"),
        "fw_target_names": TARGET_NAMES_SQL,
        "mask_config_from_file": mask_config_from_file_sql(),
        "mask_csv_mixed_headers": mask_csv_mixed_headers_sql(),
        "fw_typed_rows": fw_typed_rows_sql(),
        "fw_date_variants": fw_date_variants_sql(),
        "fw_number_clean": fw_number_clean_sql(),
        "fw_rate": fw_rate_sql(),
        "fw_width_rejects": fw_width_rejects_sql(),
        "fw_region_two_way": region_sql(False),
        "fw_region_three_way": region_sql(True),
        "fw_base_name": fw_base_name_sql(),
        "fw_exceptions": fw_exceptions_sql(),
        "fw_counts": fw_counts_sql(),
        "fw_rows_per_file": fw_rows_per_file_sql(),
        "fw_good_per_file": fw_good_per_file_sql(),
        "fw_dq_per_file": fw_dq_per_file_sql(),
        "fw_layout": fw_layout_sql(),
        "fw_layout_as_of": fw_layout_as_of_sql(),
        "fw_marker_counts": fw_marker_counts_sql(),
        "fw_summary_marker": summary_sql(True),
        "fw_summary_no_marker": summary_sql(False),
    }
    for type_name in qs.MASK_TYPE_TARGETS:
        out[f"mask_{type_name}"] = mask_type_sql(type_name)
    out["mask_config"] = mask_config_sql()
    out["mask_keyed"] = mask_keyed_sql()
    out["mask_csv_roundtrip"] = mask_keyed_sql(CUST_FILE_SQL)
    out["fw_sink_roundtrip"] = (f"SELECT * EXCLUDE (dataops_file_name_path) FROM ({fw_typed_rows_sql()})")
    return out
