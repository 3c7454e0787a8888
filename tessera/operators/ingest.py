"""Fixed-width parsing: P1-P8, F1-F3, D1-D6.

``parse_lines`` turns ``(value, file_path)`` lines into one DataFrame holding,
per line, the typed fields, the width check, the business key and an array of
data-quality errors. Every output of the job (typed table, exceptions, width
rejects, per-file counts) is a projection or filter of that frame, so one scan
and one conversion pass feed all of them.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import add, or_

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.convert import (QUICK_RE, all_plain, all_settled, convert_list, day_number, default_value, field_kind, has_default, has_plain_form,
                                 has_quick_value, joined, number_date, quick_value, spark_type)
from ..functions.text import base_name, py_strip
from ..session import saved
from .layout import Layout

# Exception table column names (in order), the "fixed" flag
# and timestamp written on every exception row, and the region markers.
EXCEPTION_COLUMNS = ("file_name", "row_business_key", "table_name", "column_name",
                     "column_value", "error_message", "row_fixed_flag", "row_fixed_timestamp")
ROW_FIXED_FLAG = "N"
ROW_FIXED_TIMESTAMP = ""
REGION_AU_MARK, REGION_NZ_MARK = ".AU_", ".NZ_"
REGION_AU, REGION_NZ = "AU", "NZ"

# Internal column names of the parsed frame.
GOOD, PATH, KEY, ERRORS, NERR, REJECT, VALUE = "_good", "_path", "_key", "_errors", "_n_errors", "_reject", "_value"


#: From here on the wide parse is used (README, "Measured").
WIDE_FROM = 40


def field_name(position: int) -> str:
    """Name of a field until it is output: layout names may be anything."""
    return f"_f{position}"


ERROR_TYPE = T.ArrayType(T.StructType([
    T.StructField("column_name", T.StringType()),
    T.StructField("column_value", T.StringType()),
    T.StructField("error_message", T.StringType()),
]))


@dataclass(frozen=True)
class ParseOptions:
    table_name: str
    date_pattern: str = "YYYYMMDD"
    # 'two_way': '.AU_' in the path -> AU, else NZ; 'three_way': AU / NZ / '';
    # 'off': null region.
    region_mode: str = "two_way"
    # Names of the two trailing output columns (path, region); None drops both.
    extra_columns: tuple[str, str] | None = ("dataops_file_name_path", "dataops_region")
    exception_columns: tuple[str, ...] = EXCEPTION_COLUMNS
    # Layouts with this many output fields or more are tested by datatype and
    # compiled field by field (``_parse_wide``).
    wide_from: int = WIDE_FROM

    def __post_init__(self):
        if self.region_mode not in ("two_way", "three_way", "off"):
            raise ValueError(f"region_mode must be two_way, three_way or off, not {self.region_mode!r}")
        if self.extra_columns is not None and len(self.extra_columns) != 2:
            raise ValueError("extra_columns needs exactly two names (path, region)")
        if len(self.exception_columns) != len(EXCEPTION_COLUMNS):
            raise ValueError(f"exception_columns needs exactly {len(EXCEPTION_COLUMNS)} names")


def region(path: Column, mode: str) -> Column:
    if mode == "two_way":
        return F.when(F.contains(path, F.lit(REGION_AU_MARK)), F.lit(REGION_AU)).otherwise(F.lit(REGION_NZ))
    if mode == "three_way":
        return (F.when(F.contains(path, F.lit(REGION_AU_MARK)), F.lit(REGION_AU))
                .when(F.contains(path, F.lit(REGION_NZ_MARK)), F.lit(REGION_NZ))
                .otherwise(F.lit("")))
    return F.lit(None).cast("string")


@dataclass
class Parsed:
    frame: DataFrame
    layout: Layout
    options: ParseOptions
    fields: dict[int, Column]  # the typed value of each output field, by position
    _persisted: list = field(default_factory=list)
    _counts: DataFrame | None = None  # what save_counts saved

    # -- outputs -------------------------------------------------------------
    def typed(self) -> DataFrame:
        """Good-width rows with typed fields, then the path and region columns."""
        cols = [self.fields[c.position].alias(c.name) for c in self.layout.output_columns]
        if self.options.extra_columns:
            path_name, region_name = self.options.extra_columns
            cols += [F.col(PATH).alias(path_name),
                     region(F.col(PATH), self.options.region_mode).alias(region_name)]
        out = self.frame.where(F.col(GOOD)).select(*cols)
        expected = [(f.name, f.dataType) for f in self.layout.schema().fields]
        got = [(f.name, f.dataType) for f in out.schema.fields[:len(expected)]]
        if got != expected:  # P3: the typed table must have the layout's schema
            raise AssertionError(f"typed schema {got} differs from the layout's {expected}")
        return out

    def _error_rows(self) -> DataFrame:
        # Only rows with errors have an array: one slot per checked field (null = no error).
        # ``inline_outer`` + a filter above the Generate: with plain ``inline``
        # Catalyst infers ``size(errors) > 0`` and pushes it down to the scan,
        # re-evaluating the whole conversion inside one huge filter.
        return (self.frame.where(F.col(GOOD))
                .select(F.col(PATH), F.col(KEY), F.inline_outer(F.col(ERRORS)))
                .where(F.col("column_name").isNotNull()))

    def exceptions(self) -> DataFrame:
        """One row per data-quality error, 8 string columns."""
        n = self.options.exception_columns
        return self._error_rows().select(
            base_name(F.col(PATH)).alias(n[0]), F.col(KEY).alias(n[1]),
            F.lit(self.options.table_name).alias(n[2]),
            F.col("column_name").alias(n[3]), F.col("column_value").alias(n[4]),
            F.col("error_message").alias(n[5]), F.lit(ROW_FIXED_FLAG).alias(n[6]),
            F.lit(ROW_FIXED_TIMESTAMP).alias(n[7]))

    def width_rejects(self) -> DataFrame:
        """Lines whose length differs from the layout width (F2): ``value, file_path``."""
        return (self.frame.where(~F.col(GOOD))
                .select(F.col(REJECT).alias("value"), F.col(PATH).alias("file_path")))

    def file_counts(self) -> DataFrame:
        """Per file: raw lines (A3), good-width lines (A4), errors, failing rows
        and distinct failing business keys (A5), in one aggregation.

        With a single distinct aggregate Spark aggregates by (file, key) first
        and by file second, both with map-side partial aggregation, so a file
        holding a third of all rows is still spread over many tasks."""
        if self._counts is not None:
            return self._counts
        n_err = F.col(NERR)
        return (self.frame.groupBy(F.col(PATH).alias("file_path"))
                .agg(F.count(F.lit(1)).alias("raw_count"),
                     F.count_if(F.col(GOOD)).alias("loaded_count"),
                     F.sum(n_err).alias("dq_error_count"),
                     F.count_if(n_err > 0).alias("dq_row_count"),
                     F.count_distinct(F.when(n_err > 0, F.col(KEY))).alias("dq_key_count")))

    def save_counts(self) -> "Parsed":
        """Aggregate ``file_counts`` once, into a shared folder (one row per file):
        every count asked for afterwards reads that and parses nothing."""
        self._counts = saved(self.file_counts(), "file-counts")
        return self

    def summary_counts(self, distinct_by: str = "key") -> DataFrame:
        """``file_path, raw_count, loaded_count, dq_count`` from one aggregation
        (the input of ``recon.file_summary`` with ``dq_per_file=None``)."""
        if distinct_by not in ("key", "row"):
            raise ValueError("distinct_by must be 'key' or 'row'")
        col = "dq_key_count" if distinct_by == "key" else "dq_row_count"
        return self.file_counts().select("file_path", "raw_count", "loaded_count",
                                         F.col(col).alias("dq_count"))

    def dq_per_file(self, distinct_by: str = "key") -> DataFrame:
        """Failing rows per file (A5), files with at least one error: distinct
        (file, business key) by default, as the reference counts;
        ``distinct_by='row'`` counts every failing row."""
        if distinct_by not in ("key", "row"):
            raise ValueError("distinct_by must be 'key' or 'row'")
        col = "dq_key_count" if distinct_by == "key" else "dq_row_count"
        return (self.file_counts().where(F.col(col) > 0)
                .select("file_path", F.col(col).alias("dq_count")))

    # -- materialization -------------------------------------------------------
    def _asked_for(self) -> DataFrame:
        """The parsed lines without the business keys of rows that have no error:
        no output asks for them, and they would be the stage's largest column."""
        return self.frame.withColumn(KEY, F.when(F.col(NERR) > 0, F.col(KEY)))

    def persist(self, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> "Parsed":
        """Keep the parsed lines so the outputs do not re-read and re-parse the text.
        Lost executor blocks are recomputed from the (short, narrow) lineage."""
        self.frame = self._asked_for().persist(level)
        self._persisted.append(self.frame)
        return self

    def stage(self, path: str) -> "Parsed":
        """Write the parsed lines once to shared storage and read them back; cuts
        lineage and survives executor loss without re-parsing."""
        self._asked_for().write.mode("overwrite").parquet(path)
        self.frame = self.frame.sparkSession.read.parquet(path)
        return self

    def unpersist(self) -> None:
        for df in self._persisted:
            df.unpersist()
        self._persisted.clear()


def parse_lines(lines: DataFrame, layout: Layout, options: ParseOptions,
                value_col: str = "value", path_col: str = "file_path") -> Parsed:
    """Parse fixed-width lines with a short chain of projections.

    Nearly every text has a plain form, which one short expression per field
    settles (``quick_value``). Only the texts that it leaves open go through the
    whole conversion (``convert_list``). The first projections cut every field
    and try the plain forms; a record's open texts are then put into one list
    for each datatype, null in the places of settled ones, and records without
    any skip the conversion. The last projection assembles typed values, the
    business key and the array of errors. All of it is narrow (no shuffle).

    No projection holds a whole conversion as columns: their code passed the
    size up to which the JIT compiles a method. Layouts of ``options.wide_from``
    fields or more would pass it by their number alone; their projections are
    not compiled as one (``_parse_wide``), with equal results.
    """
    value = F.col(value_col)
    outs = layout.output_columns
    if len(outs) >= options.wide_from:
        return _parse_wide(lines, layout, options, value_col, path_col)
    prepared = lines.select(value.alias(VALUE), F.col(path_col).alias(PATH), value.cast("binary").alias("_bytes"),
                            (F.octet_length(value) == F.length(value)).alias("_ascii"),
                            (F.length(value) == layout.record_length).alias(GOOD))
    lists = _lists(outs)
    kinds = {c.position: (name, i, kind, is_key) for name, (kind, is_key, members) in lists.items() for i, c in enumerate(members)}

    def text(c) -> Column:
        return F.col(f"_text{c.position}")

    def quick(c) -> Column:
        return F.col(f"_quick{c.position}")

    # blanks are stripped; other white space only where it costs nothing (not in
    # ASCII records), as no text that has any at its ends is settled
    cut = prepared.select(PATH, GOOD, VALUE, *(
        F.when(F.col(GOOD), F.when(F.col("_ascii"), _plain_text(c, F.col("_bytes"))).otherwise(py_strip(F.substring(VALUE, c.offset + 1, c.length)))).alias(f"_text{c.position}")
        for c in outs))
    tried = cut.select("*", *(
        (quick_value(kind, text(c)) if has_quick_value(kind, options.date_pattern, is_key) else F.lit(None).cast(spark_type(kind))).alias(f"_quick{c.position}")
        for c in outs for _, _, kind, is_key in (kinds[c.position],)))

    def still_open(members: list) -> Column:
        some = reduce(or_, (quick(c).isNull() for c in members))
        return F.when(F.col(GOOD) & some, F.array(*(F.when(quick(c).isNull(), py_strip(text(c))) for c in members)))

    kept = [PATH, GOOD, VALUE, *(f"_quick{c.position}" for c in outs)]
    opened = tried.select(*kept, *(still_open(members).alias(f"{name}_open") for name, (_, _, members) in lists.items()))
    # the list functions are interpreted: nothing of them is reached without an open text
    converted = opened.select(*kept, *(
        F.when(F.col(f"{name}_open").isNotNull(), convert_list(F.col(f"{name}_open"), kind, options.date_pattern, is_key)).alias(f"{name}_done")
        for name, (kind, is_key, _) in lists.items()))

    def done(c, part: str) -> Column:
        name, i, _, _ = kinds[c.position]
        return F.get(F.col(f"{name}_done"), F.lit(i)).getField(part)

    def bad(c) -> Column:  # a settled text is no error
        return quick(c).isNull() & F.coalesce(done(c, "bad"), F.lit(False))

    checked = [c for c in outs if kinds[c.position][2] != "string"]
    found = converted.select(
        PATH, GOOD, *(F.coalesce(quick(c), done(c, "value")).alias(field_name(c.position)) for c in outs),
        # where there is a quick form, the key's text is that of the value
        *(F.coalesce(quick(c).cast("string"), done(c, "key_text")).alias(f"_key{c.position}") for c in outs if c.is_key),
        # one slot per checked field, null when the field is fine
        *(F.when(bad(c), F.struct(F.lit(c.name).alias("column_name"), done(c, "error_text").alias("column_value"),
                                  done(c, "message").alias("error_message"))).alias(f"_error{c.position}") for c in checked),
        F.when(F.col(GOOD), reduce(add, (bad(c).cast("int") for c in checked), F.lit(0))).otherwise(F.lit(0)).alias(NERR),
        F.when(~F.col(GOOD), F.col(VALUE)).alias(REJECT))
    keys = [F.concat(F.lit(f"{c.name}="), F.col(f"_key{c.position}")) for c in outs if c.is_key]
    errors = F.array(*(F.col(f"_error{c.position}") for c in checked)) if checked else F.array().cast(ERROR_TYPE)
    frame = found.select(
        PATH, GOOD, *(field_name(c.position) for c in outs),
        (F.concat_ws("|", *keys) if keys else F.lit("")).alias(KEY),
        F.when(F.col(NERR) > 0, errors).alias(ERRORS), NERR, REJECT)
    return Parsed(frame, layout, options, {c.position: F.col(field_name(c.position)) for c in outs})


def _lists(fields) -> dict[str, tuple[str, bool, list]]:
    """Fields that are converted alike, each group under a name: ``kind, is_key, fields``."""
    groups: dict[tuple[str, bool], list] = {}
    for c in fields:
        groups.setdefault((field_kind(c.datatype), c.is_key), []).append(c)
    return {f"_list{k}": (kind, is_key, members) for k, ((kind, is_key), members) in enumerate(groups.items())}


def _plain_text(c, record: Column) -> Column:
    """A field's text in an ASCII record, given as bytes, without its blanks."""
    return F.trim(F.substring(record, F.lit(c.offset + 1), F.lit(c.length)).cast("string"))


def _apart(c: Column) -> Column:
    """``c``, by a list function: Spark interprets it, and compiles the projection
    that holds it expression by expression instead of as a part of a whole stage,
    where the code of many fields would be one method, beyond the size up to
    which the JIT compiles."""
    return F.get(F.transform(F.array(c), lambda x: x), F.lit(0))


def _parse_wide(lines: DataFrame, layout: Layout, options: ParseOptions, value_col: str, path_col: str) -> Parsed:
    """The parse of many fields, in projections that are compiled expression by
    expression (``_apart``).

    The first one cuts the texts and tests the plain forms of a datatype's texts
    all at once (``all_plain``); only where that fails is each text tested by
    itself. Its texts are cut from the bytes of any record, so that Spark takes
    those once for all fields; records that are not ASCII have theirs in
    ``_odd`` instead. A value is the plain form's or, for a text that can be
    none, the default (``has_default``). What is neither goes through the whole
    conversion in the datatype's list (``convert_list``), null in the places of
    the others. Texts that may be errors make other lists, of which the values
    need none.
    """
    outs = layout.output_columns
    lists = _lists(outs)
    quick = {name: has_quick_value(kind, options.date_pattern, is_key) for name, (kind, is_key, _) in lists.items()}
    place = {c.position: (name, i) for name, (_, _, members) in lists.items() for i, c in enumerate(members)}
    tested = [name for name, (kind, _, _) in lists.items() if quick[name] and kind != "string"]
    days = [c for c in outs if quick[place[c.position][0]] and field_kind(c.datatype) == "date"]
    even = F.col("_odd").isNull()
    text_of = {c.position: F.when(even, F.col(f"_text{c.position}")).otherwise(F.get(F.col("_odd"), F.lit(i))) for i, c in enumerate(outs)}
    stripped = {position: py_strip(t) for position, t in text_of.items()}
    known_of = {name: F.col(f"{name}_plain") if name in tested else F.lit(False) for name in lists}

    def text(c) -> Column:
        return text_of[c.position]

    def known(name: str) -> Column:
        return known_of[name]

    # the length takes longer to count than a field to convert: out of a list,
    # a filter on it is not pushed down to be counted again
    rows = lines.select(F.inline_outer(F.array(F.struct(
        F.col(path_col).alias(PATH), F.col(value_col).alias(VALUE), (F.length(F.col(value_col)) == layout.record_length).alias(GOOD)))))
    ascii_ = F.octet_length(VALUE) == layout.record_length
    places = F.array(*(F.struct(F.lit(c.offset + 1).alias("at"), F.lit(c.length).alias("size")) for c in outs))
    texts = {c.position: _plain_text(c, F.col(VALUE).cast("binary")) for c in outs}

    def flags(name: str) -> list[Column]:
        kind, _, members = lists[name]
        lines_ = joined([texts[c.position] for c in members])
        plain = all_plain(kind, lines_, len(members)) & F.col(GOOD) & ascii_
        settled = plain | (F.col(GOOD) & ascii_ & all_settled(kind, lines_, len(members)))
        return [plain.alias(f"{name}_plain"), settled.alias(f"{name}_settled")]

    cut = rows.select(
        PATH, GOOD, VALUE, *(texts[c.position].alias(f"_text{c.position}") for c in outs),
        F.when(F.col(GOOD) & ~ascii_, F.transform(places, lambda p: py_strip(F.substring(VALUE, p.getField("at"), p.getField("size"))))).alias("_odd"),
        *(flag for name in tested for flag in flags(name)))

    def convert_some(name: str, is_open, settled: Column) -> Column:
        kind, is_key, members = lists[name]
        found_open = [is_open(c) for c in members]
        some = F.coalesce(*(F.when(o, F.lit(True)) for o in found_open)).isNotNull()
        open_texts = F.array(*(F.when(o, stripped[c.position]) for o, c in zip(found_open, members, strict=True)))
        return F.when(F.col(GOOD) & ~settled & some, convert_list(open_texts, kind, options.date_pattern, is_key))

    def open_value(c) -> Column:
        name, kind = place[c.position][0], field_kind(c.datatype)
        if not quick[name]:
            return F.lit(True)
        if name not in tested:
            return ~has_plain_form(kind, text(c), known(name))
        return ~((text(c) == "") | text(c).rlike(QUICK_RE[kind]) | has_default(kind, text(c)))

    def open_error(c) -> Column:
        return ~has_plain_form(field_kind(c.datatype), text(c), known(place[c.position][0]))

    converted = cut.select(
        "*", *(day_number(text(c), known(place[c.position][0])).alias(f"_day{c.position}") for c in days),
        *(convert_some(name, open_value, F.col(f"{name}_settled") if name in tested else F.lit(False)).alias(f"{name}_done") for name in lists),
        # of dates, a plain form may be no day
        *(convert_some(name, open_error, F.lit(False) if lists[name][0] == "date" else known(name)).alias(f"{name}_found") for name in tested))

    apart = {name: _apart(F.col(f"{name}_done")) for name in lists}

    def done(c, part: str) -> Column:
        name, i = place[c.position]
        return F.get(apart[name], F.lit(i)).getField(part)

    def value_of(c) -> Column:
        name, kind = place[c.position][0], field_kind(c.datatype)
        if not quick[name]:
            return done(c, "value")
        listed = F.when(F.col(f"{name}_done").isNotNull(), done(c, "value"))
        if kind == "string":
            return F.when(F.col(GOOD), F.coalesce(listed, text(c)))
        if kind == "date":
            settled = F.when(F.col(f"_day{c.position}").isNotNull(), number_date(F.col(f"_day{c.position}")))
        else:
            settled = quick_value(kind, text(c), known(name))
        return F.when(F.col(GOOD), F.coalesce(settled, listed, default_value(kind)))

    def failing(name: str) -> Column:
        kind, _, members = lists[name]
        names = F.array(*(F.lit(c.name) for c in members))
        slots = F.transform(F.col(f"{name}_{'found' if name in tested else 'done'}"), lambda s, i: F.when(s.getField("bad"), F.struct(
            F.get(names, i).alias("column_name"), s.getField("error_text").alias("column_value"), s.getField("message").alias("error_message"))))
        return F.coalesce(F.filter(slots, lambda s: s.isNotNull()), F.array().cast(ERROR_TYPE))

    failed = [failing(name) for name, (kind, _, _) in lists.items() if kind != "string"]
    found = converted.select(
        "*", *(value_of(c).alias(field_name(c.position)) for c in outs),
        (F.concat(*failed) if failed else F.array().cast(ERROR_TYPE)).alias("_found"))

    def key_text(c) -> Column:
        # where there is a quick form, the key's text is that of the value
        return F.col(field_name(c.position)).cast("string") if quick[place[c.position][0]] else done(c, "key_text")

    keys = [F.concat(F.lit(f"{c.name}="), key_text(c)) for c in outs if c.is_key]
    n_errors = F.size("_found")
    frame = found.select(
        PATH, GOOD, *(field_name(c.position) for c in outs),
        (F.concat_ws("|", *keys) if keys else F.lit("")).alias(KEY),
        F.when(F.col(GOOD) & (n_errors > 0), F.col("_found")).alias(ERRORS),
        F.when(F.col(GOOD), n_errors).otherwise(F.lit(0)).alias(NERR),
        F.when(~F.col(GOOD), F.col(VALUE)).alias(REJECT))
    return Parsed(frame, layout, options, {c.position: F.col(field_name(c.position)) for c in outs})
