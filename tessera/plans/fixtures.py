"""Inputs for the query set, derived by Spark from the driver's tables.

``lineitem_records`` renders every ``lineitem`` row as one fixed-width record
(with defects injected by key arithmetic) and ``customer_contacts`` turns
``customer`` into a delimited-style table with personal columns. Both grow with
their source table; nothing here is a fixed small input.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.layout import Layout

# The record layout of lineitem_records (width 54).
LINEITEM_LAYOUT_CSV = """\
1,ORDER-KEY,NUMERIC,10,Y
2,LINE-NO,NUMERIC,2,Y
3,SHIP-DATE,DATE,8,N
4,QTY,SNUMERIC,6,N
5,EXT-PRICE,AMOUNT,14,N
6,DISC,RATE,6,N
7,RETURN-FLAG,STRING,3,N
8,FILLERS,STRING,5,N
"""
LINEITEM_TABLE = "LINEITEM_FW"
EMPTY_FILE, OTHER_FILE = "LI.AU_Z_20240101.TXT", "OTHER_20240101.TXT"


#: Copies of the record's fields side by side in ``wide_records`` (56 output fields).
WIDE_COPIES = 8


def wide_layout() -> Layout:
    """``lineitem_layout`` eight times over, the names numbered; the first copy has the keys."""
    rows = [line.split(",") for line in LINEITEM_LAYOUT_CSV.strip().splitlines()]
    return Layout.from_fields([(r[1] if r[1] == "FILLERS" else f"{r[1]}-{k}", r[2], int(r[3]), r[4] if k == 0 else "N")
                               for k in range(WIDE_COPIES) for r in rows])


def wide_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record eight times over in one line; short ones stay one character short."""
    lines = lineitem_records(spark, sf_dir)
    whole = F.rpad("value", 54, "Z")
    line = F.when(F.length("value") < 54, F.concat(F.repeat(whole, WIDE_COPIES - 1), "value")).otherwise(F.repeat("value", WIDE_COPIES))
    return lines.select(line.alias("value"), "file_path")


def clean_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of orders whose number makes no defect."""
    order = F.substring("value", 1, 10).cast("bigint")
    defects = [order % n != 0 for n in (13, 17, 41, 19, 23, 29, 31, 37)]
    sound = defects[0]
    for d in defects[1:]:
        sound &= d
    return lineitem_records(spark, sf_dir).where(sound)


def lineitem_layout() -> Layout:
    rows = [line.split(",") for line in LINEITEM_LAYOUT_CSV.strip().splitlines()]
    return Layout.from_fields([(r[1], r[2], int(r[3]), r[4]) for r in rows])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def two_places(x: str) -> str:
    """SQL for ``format_string('%.2f', x)`` of a double. Java's formatter is left
    the values that are no whole hundredths: it takes longer than all else in a
    record. (Where n / 100 is x, the digits of x are those of n.)"""
    n = f"try_cast({x} * 100 + 0.5D as bigint)"
    return (f"case when {x} > 0 and {x} < 1e12D and {n} / 100D = {x} then cast({n} div 100 as string) || '.' || lpad(cast({n} % 100 as string), 2, '0')"
            f" else format_string('%.2f', {x}) end")


def no_places(x: str) -> str:
    """SQL for ``format_string('%.0f', x)`` of a double, likewise: by whole
    numbers where one is near."""
    n = f"try_cast({x} + 0.5D as bigint)"
    return f"case when {x} > 0.5D and {x} < 1e12D and abs({x} - {n}) < 0.25D then cast({n} as string) else format_string('%.0f', {x}) end"


_RECORD_SQL = f"""
  lpad(cast(l_orderkey as string), 10, '0') || lpad(cast(l_linenumber as string), 2, '0')
  || case when l_orderkey % 13 = 0 then '00000000'
          when l_orderkey % 17 = 0 then '20231345'
          when l_orderkey % 41 = 0 then '15001010'
          else date_format(l_shipdate, 'yyyyMMdd') end
  || case when l_orderkey % 19 = 0 then '12A   '
          else '+' || lpad(cast(cast(l_quantity as int) as string), 5, '0') end
  || case when l_orderkey % 23 = 0 then '     12,345.00'
          else lpad({two_places('l_extendedprice')}, 14, '0') end
  || case when l_orderkey % 29 = 0 then 'x%    '
          when l_orderkey % 31 = 0 then 'abc   '
          when l_linenumber % 2 = 0 then rpad({no_places('l_discount * 100')} || '%', 6, ' ')
          else rpad({two_places('l_discount')}, 6, ' ') end
  || rpad(l_returnflag, 3, ' ') || 'ZZZZZ'
"""

_PATH_SQL = """
  '/in/LI.' || case when l_linestatus = 'O' then 'AU_' else 'NZ_' end
  || l_returnflag || '_20240101.TXT'
"""


#: Files that a landing task keeps open: rows beyond that many are sorted first.
OPEN_FILES = 64


@contextmanager
def _open_writers(spark: SparkSession) -> Iterator[None]:
    """Within it, a write by folders keeps the files of a task open instead of
    sorting the task's rows by folder, which takes memory for all of them."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(OPEN_FILES))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def land_sources(spark: SparkSession, records: DataFrame, path: str) -> None:
    """Write ``value, file_path`` as text files, one folder per source file name.

    Records are dealt by their text, so tasks are as many as their size asks for."""
    rows = records.select("value", F.element_at(F.split("file_path", "/"), -1).alias("src")).repartition("value")
    with _open_writers(spark):
        rows.write.partitionBy("src").text(path)


def land_lineitem(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Write the records as text files (one folder per source file name, ``in/``)
    and their layout (``layout/``), as a source system would land them."""
    land_sources(spark, lineitem_records(spark, sf_dir), f"{root}/in")
    write_layout(spark, f"{root}/layout")


def land_named(spark: SparkSession, sf_dir: str, root: str) -> None:
    """A landing folder as the source system leaves it: ``in/`` holds one file
    per source file name, an empty file that is listed, and a file of another
    feed; ``layout/`` the layout; ``marker/`` the control counts, one line per
    listed file in name order."""
    records = lineitem_records(spark, sf_dir).select("value", F.element_at(F.split("file_path", "/"), -1).alias("src"))
    with _open_writers(spark):
        records.repartition("src").write.partitionBy("src").text(f"{root}/parts")
    spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_name").coalesce(1).write.text(f"{root}/other")
    write_layout(spark, f"{root}/layout")
    empty = spark.range(1).select(F.lit(EMPTY_FILE).alias("src"), F.lit(0).cast("long").alias("n"))
    landed = spark.read.schema("value string, src string").text(f"{root}/parts")
    counts = landed.groupBy("src").agg(F.count(F.lit(1)).alias("n")).unionByName(empty)
    (counts.orderBy("src").select(F.concat("src", F.lit(": "), F.col("n").cast("string")).alias("value"))
     .coalesce(1).write.text(f"{root}/marker"))
    # Spark names part files itself; a source system's names are what the job reads
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop.Path(f"{root}/in"))
    for folder, name in [("other", OTHER_FILE), *((d.getPath().getName(), "") for d in fs.listStatus(hadoop.Path(f"{root}/parts")) if d.isDirectory())]:
        source = f"{root}/{folder}" if name else f"{root}/parts/{folder}"
        for part in fs.listStatus(hadoop.Path(source)):
            if part.getPath().getName().startswith("part-"):
                fs.rename(part.getPath(), hadoop.Path(f"{root}/in/{name or folder.partition('=')[2]}"))
    fs.create(hadoop.Path(f"{root}/in/{EMPTY_FILE}")).close()


def write_layout(spark: SparkSession, path: str) -> None:
    (spark.createDataFrame([(line,) for line in LINEITEM_LAYOUT_CSV.strip().splitlines()], "value string")
     .coalesce(1).write.text(path))


def lineitem_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value, file_path``: one 54-character record per lineitem row; rows with
    ``l_orderkey % 37 = 0`` are one character short (width rejects).

    The records come out of a one-element ``inline_outer``: filters on
    ``value`` (the width check) then stay above it instead of being pushed
    down with the whole record-building expression inlined into them. Real
    landing data is read as text, where ``value`` is a plain column.
    """
    li = table(spark, sf_dir, "lineitem")
    built = li.select(F.expr(_PATH_SQL).alias("file_path"), F.col("l_orderkey"),
                      F.expr(_RECORD_SQL).alias("line"))
    value = F.when(F.col("l_orderkey") % 37 == 0, F.substring("line", 1, 53)).otherwise(F.col("line"))
    return built.select(F.inline_outer(F.array(F.struct(value.alias("value"), F.col("file_path")))))


CONTACT_SQL = {
    "cust_id": "cast(c_custkey as string)",
    "full_name": "c_name",
    "gender": "case when c_custkey % 3 = 0 then 'F' when c_custkey % 3 = 1 then 'M' end",
    "contact_type": ("case when c_custkey % 4 = 0 then 'Email address' "
                     "when c_custkey % 4 = 1 then 'Mobile Phone' "
                     "when c_custkey % 4 = 2 then 'Postal' end"),
    "contact_value": ("case when c_custkey % 4 = 0 then 'cust' || cast(c_custkey as string) || '@example.com' "
                      "when c_custkey % 4 = 1 then '04' || lpad(cast(c_custkey as string), 8, '0') "
                      "when c_custkey % 4 = 2 then '' end"),
    "segment": "c_mktsegment",
}


def customer_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-string customer table with null/blank contact values, null gender and
    null contact type (as a delimited file would give)."""
    cust = table(spark, sf_dir, "customer")
    return cust.select(*[F.expr(sql).alias(name) for name, sql in CONTACT_SQL.items()])
