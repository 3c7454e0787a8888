"""Record layouts: loading (S3), width/keys (A8), offsets (J4), names (C8), as-of pick.

A layout is a headerless CSV with one row per field, positional:
``ordinal, name, datatype, length, key_flag``. Fields named ``FILLERS`` take
space in the record but are not output. The layout is the only thing this
package collects to the driver: one small row per field.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.convert import spark_type
from ..functions.text import base_name

# The filler field name and the key flag.
FILLER_NAME = "FILLERS"
KEY_FLAG = "Y"

LAYOUT_CSV_SCHEMA = T.StructType([
    T.StructField("c_ordinal", T.StringType()),
    T.StructField("c_name", T.StringType()),
    T.StructField("c_datatype", T.StringType()),
    T.StructField("c_length", T.StringType()),
    T.StructField("c_key", T.StringType()),
])


@dataclass(frozen=True)
class LayoutColumn:
    position: int      # 0-based order in the layout file
    name: str          # '-' already replaced with '_'
    datatype: str      # trimmed, lower case
    length: int
    is_key: bool
    offset: int        # 0-based start within the record

    @property
    def is_filler(self) -> bool:
        return self.name == FILLER_NAME


@dataclass(frozen=True)
class Layout:
    columns: tuple[LayoutColumn, ...]

    @classmethod
    def from_fields(cls, fields: list[tuple[str, str, int, str]]) -> "Layout":
        """Build from ``(name, datatype, length, key_flag)`` tuples in record order."""
        cols, offset = [], 0
        for pos, (name, datatype, length, flag) in enumerate(fields):
            cols.append(LayoutColumn(pos, str(name).replace("-", "_"),
                                     str(datatype).strip().lower(), int(length),
                                     str(flag).strip() == KEY_FLAG, offset))
            offset += int(length)
        return cls(tuple(cols))

    @cached_property
    def record_length(self) -> int:
        return sum(c.length for c in self.columns)

    @cached_property
    def output_columns(self) -> tuple[LayoutColumn, ...]:
        return tuple(c for c in self.columns if not c.is_filler)

    @cached_property
    def key_names(self) -> tuple[str, ...]:
        return tuple(c.name for c in self.output_columns if c.is_key)

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, spark_type(c.datatype), True)
                             for c in self.output_columns])


def read_layout_frame(spark: SparkSession, path: str) -> DataFrame:
    """S3 + C8 + A8 + J4 as a DataFrame: one row per layout field with its offset.

    Columns: position, column_name, column_datatype, column_length, is_key, offset,
    record_length.
    """
    raw = (spark.read.schema(LAYOUT_CSV_SCHEMA).option("header", "false").csv(path)
           .withColumn("_pos", F.monotonically_increasing_id()))
    return layout_frame(raw)


def layout_frame(raw: DataFrame) -> DataFrame:
    """Normalize raw layout rows (``c_name, c_datatype, c_length, c_key, _pos``)."""
    # A layout has tens to hundreds of rows, so one ordered window is fine.
    order = Window.orderBy("_pos")
    whole = Window.partitionBy()
    length = F.col("c_length").try_cast("int")
    return (raw.select(
                (F.row_number().over(order) - 1).alias("position"),
                F.replace(F.col("c_name"), F.lit("-"), F.lit("_")).alias("column_name"),
                F.lower(F.trim(F.col("c_datatype"))).alias("column_datatype"),
                length.alias("column_length"),
                (F.trim(F.col("c_key")) == KEY_FLAG).alias("is_key"),
                (F.sum(length).over(order.rowsBetween(Window.unboundedPreceding, -1))).alias("_before"),
                F.sum(length).over(whole).alias("record_length"))
            .select("position", "column_name", "column_datatype", "column_length", "is_key",
                    F.coalesce("_before", F.lit(0)).cast("int").alias("offset"),
                    F.col("record_length").cast("int").alias("record_length")))


def load_layout(spark: SparkSession, path: str) -> Layout:
    """Read a layout file and bring it to the driver (one small row per field)."""
    rows = read_layout_frame(spark, path).orderBy("position").collect()
    if not rows:
        raise ValueError(f"layout {path} has no rows")
    bad = [r.column_name for r in rows if r.column_length is None]
    if bad:
        raise ValueError(f"layout {path}: non-integer length for {bad}")
    return Layout.from_fields([(r.column_name, r.column_datatype, r.column_length,
                                KEY_FLAG if r.is_key else "N") for r in rows])


def pick_layout_as_of(listing: DataFrame, run_date: str, file_prefix: str,
                      path_col: str = "file_path") -> DataFrame:
    """S4 + A7: the newest layout whose name carries a date on or before ``run_date``.

    Candidates are the files whose base name starts with ``file_prefix`` with
    its dots removed; the date is the first 8-digit run in the base name and
    names whose 8 digits are not a valid ``yyyyMMdd`` date are skipped. Ties on
    the date go to the first path in name order. Returns 0 or 1 row:
    ``file_path, layout_date``.
    """
    prefix = file_prefix.replace(".", "")
    name = base_name(F.col(path_col))
    d = F.try_to_date(F.regexp_extract(name, "([0-9]{8})", 1), "yyyyMMdd")
    run = F.to_date(F.lit(run_date), "yyyyMMdd")
    return (listing
            .select(F.col(path_col).alias("file_path"), name.alias("_name"), d.alias("layout_date"))
            .where(F.startswith(F.col("_name"), F.lit(prefix)) & (F.col("layout_date") <= run))
            .orderBy(F.col("layout_date").desc(), F.col("file_path"))
            .limit(1)
            .drop("_name"))


def layout_slices(lines: DataFrame, layout: Layout, value_col: str = "value") -> DataFrame:
    """One row per record and non-filler field: the field's raw slice and its place.

    Uses ``inline_outer`` over a per-row array, so it is a narrow, shuffle-free
    expansion (no join against the layout) and Catalyst infers no filter on
    the array to push below it.
    """
    structs = [F.struct(F.lit(c.position).alias("position"), F.lit(c.name).alias("column_name"),
                        F.lit(c.datatype).alias("column_datatype"), F.lit(c.offset).alias("offset"),
                        F.lit(c.length).alias("column_length"), F.lit(c.is_key).alias("is_key"),
                        F.substring(F.col(value_col), c.offset + 1, c.length).alias("slice"))
               for c in layout.output_columns]
    return lines.select(F.col(value_col), F.inline_outer(F.array(*structs)))


def field_slice(value: Column, c: LayoutColumn, value_bytes: Column | None = None,
                ascii_only: Column | None = None) -> Column:
    """The field's characters. Finding a character offset in a UTF-8 string
    walks the string from its start, so cutting many fields from a long record
    costs quadratic time; for records that are pure ASCII (``ascii_only``) the
    slice is cut from the bytes (``value_bytes``) at a constant-time offset."""
    chars = F.substring(value, c.offset + 1, c.length)
    if value_bytes is None:
        return chars
    return F.when(ascii_only, F.substring(value_bytes, c.offset + 1, c.length).cast("string")).otherwise(chars)
