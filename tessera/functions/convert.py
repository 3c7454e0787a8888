"""Typed conversion of fixed-width field text, as native Column expressions.

Each builder takes the field text ``v`` (already stripped of Python whitespace)
and returns a :class:`Converted`: the typed value with its default applied, a
boolean "this value is a data-quality error" column, the text reported in the
error row, and the text used for the row's business key.

The rules mirror the behaviour of Python's ``int``/``Decimal``/``float``/
``strptime`` on the stripped text (regex guards reproduce what those parsers
accept, so Spark's more permissive casts never decide validity), with these
deliberate differences: non-ASCII digits are not accepted, and values that do
not fit the target type (long overflow, more than 20 integer digits in an
amount, NaN/Infinity amounts) are reported as errors with the default value
instead of failing the job.
"""

from __future__ import annotations

import datetime
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import PY_WHITESPACE, WS_CLASS, py_strip

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for equal results.
# Default values written when a field is blank or cannot be converted:
DEFAULT_DATE = datetime.date(1901, 1, 1)
DEFAULT_NUMBER = 0
DEFAULT_RATE = 0.0
# Dates before this day are replaced by DEFAULT_DATE without an error:
GREGORIAN_START = datetime.date(1582, 10, 15)
# Field values treated as "no date" (default, no error):
ZERO_DATE = "00000000"
# Error messages, in the order: date, numeric/snumeric, amount, rate with %, plain rate:
MSG_DATE = "Failed to parse date value as it doesn't have date value in a format YYYYMMDD"
MSG_LONG = "Failed to cast the column to long type from source data type - NUMERIC/SNUMERIC"
MSG_DECIMAL = "Failed to cast the column to decimal from source data type - AMOUNT"
MSG_RATE_PCT = ("Failed to cast the column to float from source data type - "
                "rate where source field is expected to be populated with %")
MSG_RATE = "Failed to cast the column to float from source data type - rate"
# Layout datatype names -> Spark types; any other name is a string column:
SPARK_TYPES = {
    "string": T.StringType(),
    "numeric": T.LongType(),
    "amount": T.DecimalType(38, 18),
    "snumeric": T.LongType(),
    "date": T.DateType(),
    "rate": T.FloatType(),
}
# ---------------------------------------------------------------------------

DECIMAL_TYPE = T.DecimalType(38, 18)


def spark_type(datatype: str) -> T.DataType:
    return SPARK_TYPES.get(str(datatype).strip().lower(), T.StringType())


@dataclass(frozen=True)
class Converted:
    value: Column          # typed value, default applied
    bad: Column | None     # True when the value is a data-quality error (None: never)
    error_text: Column     # column_value reported in the exception row
    message: Column | None # error_message reported in the exception row
    key_text: Column       # text of the converted value for the business key


@dataclass(frozen=True)
class FieldPlan:
    """How to convert one field, as projections applied one after another.

    ``stages[k]`` maps local names to expressions that may refer to the input
    ``v`` and to names of earlier stages (through ``ref``). Each intermediate is
    a named column computed once; later stages and ``result`` only refer to it,
    so no sub-expression is copied into every use (which would bloat the
    generated code past what the JIT compiles).
    """
    stages: list[dict[str, Column]]
    result: Converted


Ref = Callable[[str], Column]


# --- regex building blocks (Java regex and RE2 agree on all of them) -------
_DIGITS = "[0-9]+(?:_[0-9]+)*"  # digits with single underscores between them
INT_RE = f"^{WS_CLASS}*-?{_DIGITS}{WS_CLASS}*$"
# Decimal(): '+' is already removed and every '_' dropped before this test.
DEC_RE = r"^-?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][-+]?[0-9]+)?$"
FLOAT_NUM_RE = (f"^{WS_CLASS}*[-+]?(?:{_DIGITS}(?:\\.(?:{_DIGITS})?)?|\\.{_DIGITS})"
                 f"(?:[eE][-+]?{_DIGITS})?{WS_CLASS}*$")
# Plain forms, tried first: nearly every value has one, and they are cheap to test.
PLAIN_INT_RE = "^-?[0-9]+$"
PLAIN_FLOAT_RE = r"^[-+]?[0-9]+(?:\.[0-9]*)?$"
PLAIN_DATE_RE = "^[0-9]{8}$"
FLOAT_SPECIAL_RE = f"(?i)^{WS_CLASS}*([-+]?)(inf|infinity|nan){WS_CLASS}*$"
STRIP_NUM_CHARS = f"(?:_|{WS_CLASS})"


def _squeeze(c: Column) -> Column:
    """Drop underscores and whitespace so Spark's cast sees plain digits
    (``translate`` deletes characters that have no replacement)."""
    return F.translate(c, "_" + PY_WHITESPACE, "")


def number_text_stages(ref: Ref) -> list[dict[str, Column]]:
    """Number-text cleaning shared by numeric, snumeric and amount fields, as
    stages of plain string functions (no regex).

    Remove every ``+``, strip, drop leading zeros, put ``0`` before a leading
    point and ``00`` after a point in last place, and turn an empty result into
    ``0``.
    """
    return [
        # the text is stripped already: only a removed sign can lay bare more blanks
        {"t0": F.ltrim(F.when(F.contains(ref("v"), F.lit("+")), py_strip(F.replace(ref("v"), F.lit("+"), F.lit(""))))
                       .otherwise(ref("v")), F.lit("0"))},
        {"t1": F.when(F.startswith(ref("t0"), F.lit(".")), F.concat(F.lit("0"), ref("t0")))
                .otherwise(ref("t0"))},
        # a point in last place that is also the first point gets "00"
        {"t": F.when(F.endswith(ref("t1"), F.lit(".")) & (F.instr(ref("t1"), ".") == F.length(ref("t1"))),
                     F.concat(ref("t1"), F.lit("00")))
               .when(ref("t1") == "", F.lit("0"))
               .otherwise(ref("t1"))},
    ]


def plan_long(ref: Ref, with_key: bool = True) -> FieldPlan:
    stages = number_text_stages(ref) + [
        {"p": F.when(ref("t").rlike(PLAIN_INT_RE), ref("t").try_cast("bigint"))
              .when(ref("t").rlike(INT_RE), _squeeze(ref("t")).try_cast("bigint"))}]
    value = F.coalesce(ref("p"), F.lit(DEFAULT_NUMBER).cast("bigint"))
    return FieldPlan(stages, Converted(value, ref("p").isNull(), ref("t"), F.lit(MSG_LONG),
                                       value.cast("string")))


def plan_decimal(ref: Ref, with_key: bool = True) -> FieldPlan:
    stages = number_text_stages(ref) + [
              # Decimal() strips whitespace first, then drops every underscore
              {"n": F.when(ref("t").rlike(PLAIN_FLOAT_RE), ref("t"))
                     .otherwise(F.replace(py_strip(ref("t")), F.lit("_"), F.lit("")))},
              {"p": F.when(ref("n").rlike(DEC_RE), ref("n").try_cast(DECIMAL_TYPE))}]
    key = F.lit("")
    if with_key:
        key_stages, text = decimal_text_stages(ref)
        stages += key_stages
        key = F.when(ref("p").isNull(), F.lit("0")).otherwise(text)
    value = F.coalesce(ref("p"), F.lit(DEFAULT_NUMBER).cast(DECIMAL_TYPE))
    return FieldPlan(stages, Converted(value, ref("p").isNull(), ref("t"), F.lit(MSG_DECIMAL), key))


def plan_rate(ref: Ref, with_key: bool = True) -> FieldPlan:
    """Rate: ``%`` form strips ``%`` at both ends and divides by 100; otherwise a
    plain float. Blank is an error. Division happens in double, then narrows."""
    v = ref("v")
    stages = [
        {"h": F.contains(v, F.lit("%")),
         "t": F.when(F.contains(v, F.lit("%")), F.btrim(v, F.lit("%"))).otherwise(v)},
        {"num": F.when(ref("t").rlike(PLAIN_FLOAT_RE), ref("t").try_cast("double"))
                 .when(ref("t").rlike(FLOAT_NUM_RE), _squeeze(ref("t")).try_cast("double"))},
        {"sp": F.when(ref("num").isNotNull(), F.lit("")).otherwise(F.regexp_extract(ref("t"), FLOAT_SPECIAL_RE, 0))},
        {"p": F.when(ref("sp") == "", ref("num"))
               .when(F.contains(F.lower(ref("sp")), F.lit("nan")), F.lit(float("nan")))
               .when(F.contains(ref("sp"), F.lit("-")), F.lit(float("-inf")))
               .otherwise(F.lit(float("inf")))
               / F.when(ref("h"), F.lit(100.0)).otherwise(F.lit(1.0))},
    ]
    as_double = F.coalesce(ref("p"), F.lit(DEFAULT_RATE))
    key = F.lit("")
    if with_key:
        key_stages, key = python_float_text_stages(ref, as_double)
        stages += key_stages
    message = F.when(ref("h"), F.lit(MSG_RATE_PCT)).otherwise(F.lit(MSG_RATE))
    return FieldPlan(stages, Converted(as_double.cast("float"), ref("p").isNull(), v, message, key))


# --- dates ------------------------------------------------------------------
_DIRECTIVES = {
    # strptime's own sub-patterns; the day has a second branch for " 5".
    "Y": ("([0-9]{4})", 1),
    "m": ("(1[0-2]|0[1-9]|[1-9])", 1),
    "d": ("(?:(3[01]|[12][0-9]|0[1-9]|[1-9])| ([1-9]))", 2),
}
_REGEX_SPECIALS = set("\\.^$*+?(){}[]|")


# The tokens of a caller's date pattern (any case).
_DATE_TOKEN = re.compile(r"(?P<Y>yyyy)|(?P<m>mm)|(?P<d>dd)|(?P<space>\s+)|(?P<other>.)", re.I | re.S)


def date_regex(pattern: str) -> tuple[str, str]:
    """Regex for texts of ``pattern`` and a replacement producing ``y-m-d``.

    Follows Python's ``strptime``: literal characters match case-insensitively, whitespace
    runs match one or more whitespace characters, and the whole text must be
    consumed. Fields the pattern lacks take strptime's defaults (1900-01-01).
    """
    parts: list[str] = []
    groups: dict[str, list[int]] = {}
    n = 0
    for token in _DATE_TOKEN.finditer(pattern):
        kind, text = token.lastgroup, token[0]
        if kind in _DIRECTIVES:
            if kind in groups:
                raise ValueError(f"date pattern {pattern!r} names a part twice")
            rx, width = _DIRECTIVES[kind]
            groups[kind] = list(range(n + 1, n + 1 + width))
            n += width
            parts.append(rx)
        elif kind == "space":
            parts.append(WS_CLASS + "+")
        elif text == "%":
            raise ValueError(f"date pattern {pattern!r} holds a percent sign")
        else:
            parts.append("\\" + text if text in _REGEX_SPECIALS else text)

    def ref(d: str, default: str) -> str:
        return "".join(f"${g}" for g in groups[d]) if d in groups else default

    regex = "(?i)^(?:" + "".join(parts) + ")$"
    return regex, f"{ref('Y', '1900')}-{ref('m', '1')}-{ref('d', '1')}"


def is_day(v: Column) -> Column:
    """Whether eight digits, ``yyyymmdd``, are a day of the calendar (no year 0).
    A cast of a text that is none is null too, but makes an exception first,
    which takes far longer than all else that is done to a date."""
    year, month, day = F.substring(v, 1, 4), F.substring(v, 5, 2), F.substring(v, 7, 2)
    y = year.try_cast("int")
    leap = (y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0))
    last = (F.when(month == "02", F.when(leap, F.lit("29")).otherwise(F.lit("28")))
            .when(month.isin("04", "06", "09", "11"), F.lit("30")).otherwise(F.lit("31")))
    return (year != "0000") & month.between("01", "12") & day.between(F.lit("01"), last)


_MATCH_MARK = "\u0001"


def plan_date(ref: Ref, pattern: str = "YYYYMMDD", with_key: bool = True) -> FieldPlan:
    """Blank or all-zero -> default, no error; unparsable -> default + error;
    before 1582-10-15 -> default, no error.

    One regex pass turns a match into ``y-m-d``; the date is then built with
    ``make_date`` once the day is known to exist in its month (e.g. no 30
    February), which avoids the datetime parser.
    """
    regex, template = date_regex(pattern)
    v = ref("v")
    y, m, d = (F.element_at(ref("parts"), i).cast("int") for i in (1, 2, 3))
    # eight digits can only be year, month and day in full
    compact = v.rlike(PLAIN_DATE_RE) if pattern.upper() == "YYYYMMDD" else F.lit(False)
    year = F.substring(v, 1, 4)
    iso = F.concat(year, F.lit("-"), F.substring(v, 5, 2), F.lit("-"), F.substring(v, 7, 2))
    stages = [
        {"q": compact},
        {"r": F.when(~ref("q"), F.regexp_replace(v, regex, _MATCH_MARK + template))},
        {"parts": F.when(F.startswith(ref("r"), F.lit(_MATCH_MARK)) & ~F.startswith(v, F.lit(_MATCH_MARK)),
                         F.split(F.substr(ref("r"), F.lit(2)), "-"))},
        # year 0 does not exist (strptime rejects it); the month is 1-12 by the
        # regex; the day must exist in that month (no 30 February)
        {"p": F.when(ref("q"), F.when(is_day(v), iso.try_cast("date")))
              .when((y >= 1) & (d <= F.dayofmonth(F.last_day(F.make_date(y, m, F.lit(1))))),
                     F.make_date(y, m, d))},
    ]
    blank = (v == "") | (v == ZERO_DATE)
    value = (F.when(blank | ref("p").isNull() | (ref("p") < F.lit(GREGORIAN_START)), F.lit(DEFAULT_DATE))
             .otherwise(ref("p")))
    bad = ~blank & ref("p").isNull()
    return FieldPlan(stages, Converted(value, bad, v, F.lit(MSG_DATE), value.cast("string")))


def plan_string(ref: Ref, with_key: bool = True) -> FieldPlan:
    return FieldPlan([], Converted(ref("v"), None, ref("v"), None, ref("v")))


def plan_field(datatype: str, ref: Ref, date_pattern: str = "YYYYMMDD", with_key: bool = True) -> FieldPlan:
    t = str(datatype).strip().lower()
    if t in ("numeric", "snumeric"):
        return plan_long(ref, with_key)
    if t == "amount":
        return plan_decimal(ref, with_key)
    if t == "date":
        return plan_date(ref, date_pattern, with_key)
    if t == "rate":
        return plan_rate(ref, with_key)
    return plan_string(ref, with_key)


def convert_columns(df: DataFrame, fields: list[tuple[str, Column, str]], keep: list,
                    date_pattern: str = "YYYYMMDD", key_fields: set[str] | frozenset = frozenset()
                    ) -> tuple[DataFrame, dict[str, Converted]]:
    """Apply the staged conversion of several fields.

    ``fields``: ``(prefix, stripped text, datatype)``; intermediate columns are
    named ``<prefix><local name>``. Returns the staged frame (``keep`` columns
    plus intermediates) and each field's :class:`Converted`, whose expressions
    refer to the staged columns. Unused intermediates are pruned by Catalyst.
    """
    plans = {prefix: plan_field(dt, (lambda n, p=prefix: F.col(f"{p}{n}")), date_pattern,
                                with_key=prefix in key_fields)
             for prefix, _, dt in fields}
    cur = df.select(*keep, *[src.alias(f"{prefix}v") for prefix, src, _ in fields])
    depth = max((len(p.stages) for p in plans.values()), default=0)
    for k in range(depth):
        new = [expr.alias(f"{prefix}{name}") for prefix, plan in plans.items()
               if k < len(plan.stages) for name, expr in plan.stages[k].items()]
        cur = cur.select("*", *new)
    return cur, {prefix: plan.result for prefix, plan in plans.items()}


def field_kind(datatype: str) -> str:
    """Datatypes of one kind are converted alike: ``numeric`` and ``snumeric``
    are, and every unknown name is a string."""
    t = str(datatype).strip().lower()
    return "numeric" if t == "snumeric" else t if t in SPARK_TYPES else "string"


def convert_list(texts: Column, kind: str, date_pattern: str = "YYYYMMDD", with_key: bool = False) -> Column:
    """The staged conversion of many fields of one kind, as one expression.

    ``texts`` is the array of their stripped texts. Every stage is a
    ``transform`` that adds its intermediates to the element's struct, so the
    plan has the size of one field however many there are. Elements of the
    result: ``value, bad, error_text, message, key_text``; the texts are null
    unless the value is an error or a key. Null elements stay null, and cost
    nothing but the passing.
    """
    def plan(element: Column) -> FieldPlan:
        return plan_field(kind, element.getField, date_pattern, with_key)

    stages = [list(stage) for stage in plan(F.lit(None)).stages]
    names, current = ["v"], F.transform(texts, lambda v: F.when(v.isNotNull(), F.struct(v.alias("v"))))

    def stage(k: int, before: tuple[str, ...]) -> Callable[[Column], Column]:
        def step(s: Column) -> Column:
            return F.when(s.isNotNull(), F.struct(*(s.getField(n).alias(n) for n in before), *(e.alias(n) for n, e in plan(s).stages[k].items())))
        return step

    for k, added in enumerate(stages):
        current = F.transform(current, stage(k, tuple(names)))
        names += added

    def finish(s: Column) -> Column:
        c = plan(s).result
        bad = F.lit(False) if c.bad is None else c.bad
        text, message = (F.lit(None).cast("string") if x is None or c.bad is None else F.when(bad, x) for x in (c.error_text, c.message))
        return F.when(s.isNotNull(), F.struct(
            c.value.alias("value"), bad.alias("bad"), text.alias("error_text"), message.alias("message"),
            (c.key_text if with_key else F.lit(None).cast("string")).alias("key_text")))

    return F.transform(current, finish)


# Forms that quick_value settles; \z: a line break at the end is no plain form.
QUICK_INT_RE = r"^[-+]?[0-9]{1,18}\z"
QUICK_DECIMAL_RE = r"^[-+]?[0-9]{1,20}(?:\.[0-9]{1,18})?\z"
QUICK_RATE_RE = r"^[-+]?[0-9]+(?:\.[0-9]*)?%?\z"
QUICK_DATE_RE = r"^[0-9]{8}\z"


def has_quick_value(kind: str, date_pattern: str, is_key: bool) -> bool:
    """Whether ``quick_value`` serves fields of this kind. Keys must have the
    text of their value, which amounts and rates don't."""
    if kind == "date":
        return date_pattern.upper() == "YYYYMMDD"
    return not (is_key and kind in ("amount", "rate"))


def quick_value(kind: str, v: Column, known: Column | None = None) -> Column:
    """The converted value of a text in plain form, equal to that of
    ``plan_field``; null where the text needs the whole conversion, always so
    if it is an error. Of an ASCII text only the blanks need be stripped: with
    other white space at an end it has no plain form. Numbers ``known`` to have
    a plain form (``all_plain``) are not tested again."""
    def plain(regex: str) -> Column:
        return v.rlike(regex) if known is None else known | v.rlike(regex)

    if kind == "numeric":
        return F.when(v == "", F.lit(DEFAULT_NUMBER).cast("bigint")).when(plain(QUICK_INT_RE), v.try_cast("bigint"))
    if kind == "amount":
        return F.when(v == "", F.lit(DEFAULT_NUMBER).cast(DECIMAL_TYPE)).when(plain(QUICK_DECIMAL_RE), v.try_cast(DECIMAL_TYPE))
    if kind == "rate":  # a plain form has its only % at the end
        number = F.when(F.endswith(v, F.lit("%")), F.substring_index(v, "%", 1).try_cast("double") / 100.0).otherwise(v.try_cast("double"))
        return F.when(plain(QUICK_RATE_RE), number.cast("float"))
    if kind == "date":
        year = F.substring(v, 1, 4)
        day = F.concat(year, F.lit("-"), F.substring(v, 5, 2), F.lit("-"), F.substring(v, 7, 2)).try_cast("date")
        start = GREGORIAN_START.strftime("%Y%m%d")
        return (F.when((v == "") | (v == ZERO_DATE), F.lit(DEFAULT_DATE))
                .when(plain(QUICK_DATE_RE) & is_day(v),
                      F.when(v >= start, day).otherwise(F.lit(DEFAULT_DATE))))
    # from "!" on, no character of ASCII is white space
    return F.when((v == "") | ((v >= "!") & (F.substring(v, -1, 1) >= "!")), v)


def has_plain_form(kind: str, v: Column, known: Column) -> Column:
    """Whether ``quick_value`` settles a text: it is no error then."""
    if kind == "date":
        return (v == "") | (v == ZERO_DATE) | ((known | v.rlike(QUICK_DATE_RE)) & is_day(v))
    if kind == "string":
        return quick_value(kind, v).isNotNull()
    plain = known | v.rlike(QUICK_RE[kind])
    return plain if kind == "rate" else (v == "") | plain


#: The plain forms by kind.
QUICK_RE = {"numeric": QUICK_INT_RE, "amount": QUICK_DECIMAL_RE, "rate": QUICK_RATE_RE, "date": QUICK_DATE_RE}
#: The same for texts that each end in a line break (possessive: none is read twice).
_QUICK_LINE_RE = {
    "numeric": r"(?:[-+]?+[0-9]{1,18}+)?+\n",
    "amount": r"(?:[-+]?+[0-9]{1,20}+(?:\.[0-9]{1,18}+)?+)?+\n",
    "rate": r"[-+]?+[0-9]++(?:\.[0-9]*+)?+%?+\n",
    "date": r"(?:[0-9]{8}+)?+\n",
}


def _others(allowed: str) -> str:
    """The printable ASCII characters that are not ``allowed``, for a regex class."""
    return "".join(f"\\x{n:02x}" for n in range(0x21, 0x7F) if chr(n) not in allowed)


#: Characters that make a text an error wherever they stand in it.
_FOREIGN = {
    "numeric": _others("0123456789+-._"),
    "amount": _others("0123456789+-._eE"),
    "rate": _others("0123456789+-._eE%" + "infinitynan" + "INFINITYNAN"),
    "date": _others("0123456789"),
}


def has_default(kind: str, v: Column) -> Column:
    """Whether a text without a plain form has its kind's default for its value
    as a glance at its characters shows (False: the conversion must tell)."""
    if kind == "string":
        return F.lit(False)
    foreign = v.rlike(f"[{_FOREIGN[kind]}]")
    return foreign | (v == "") if kind == "rate" else foreign


def joined(texts: list[Column]) -> Column:
    """The texts that ``all_plain`` and ``all_settled`` test, as one. (Another
    line break, within a text, makes one line too many.)"""
    return F.concat_ws("\n", *texts, F.lit(""))


def all_plain(kind: str, text: Column, n: int) -> Column:
    """Whether ``n`` joined texts of numbers or dates all match the kind's plain
    form or, except rates, are blank, by one regex for all of them."""
    return text.rlike(f"^(?:{_QUICK_LINE_RE[kind]}){{{n}}}+\\z")


def all_settled(kind: str, text: Column, n: int) -> Column:
    """Whether all are that, or have the default (``has_default``)."""
    foreign = _FOREIGN[kind]
    return text.rlike(f"^(?:{_QUICK_LINE_RE[kind]}|\n|[^\n{foreign}]*+[{foreign}][^\n]*+\n){{{n}}}+\\z")


def default_value(kind: str) -> Column:
    """What a blank text or an error is replaced by."""
    default = {"date": DEFAULT_DATE, "rate": DEFAULT_RATE, "string": ""}.get(kind, DEFAULT_NUMBER)
    return F.lit(default).cast(spark_type(kind))


def day_number(v: Column, known: Column) -> Column:
    """Eight digits, ``yyyymmdd``, as a number; null for other texts."""
    return F.when((v != "") & (known | v.rlike(QUICK_DATE_RE)), v.try_cast("int"))


def number_date(n: Column) -> Column:
    """The converted value of a day number: ``DEFAULT_DATE`` if it is no day, or
    one before the calendar's start."""
    def div(k: int) -> Column:
        return F.call_function("div", n, F.lit(k)).cast("int")

    year, month, day = div(10_000), div(100) % 100, n % 100
    leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
    last = (F.when(month == 2, F.when(leap, F.lit(29)).otherwise(F.lit(28)))
            .when(month.isin(4, 6, 9, 11), F.lit(30)).otherwise(F.lit(31)))
    real = (n >= int(GREGORIAN_START.strftime("%Y%m%d"))) & month.between(1, 12) & (day >= 1) & (day <= last)
    return F.when(real, F.make_date(year, month, day)).otherwise(F.lit(DEFAULT_DATE))


def convert_one(df: DataFrame, text: Column, datatype: str, prefix: str, keep: list,
                date_pattern: str = "YYYYMMDD", with_key: bool = False) -> tuple[DataFrame, Converted]:
    staged, conv = convert_columns(df, [(prefix, text, datatype)], keep, date_pattern,
                                   {prefix} if with_key else frozenset())
    return staged, conv[prefix]


# --- business-key text: Python's str() of the converted value ---------------

def decimal_text_stages(ref: Ref) -> tuple[list[dict[str, Column]], Column]:
    """``str(Decimal(n))`` for ``n``, a text known to be a finite decimal.

    Python keeps the coefficient digits as written and switches to scientific
    notation when the exponent is positive or the adjusted exponent is below -6.
    """
    rx = r"^(-?)([0-9]*)(?:\.([0-9]*))?(?:[eE]([-+]?[0-9]+))?$"
    n = ref("n")
    stages = [
        {"ks": F.regexp_extract(n, rx, 1), "ki": F.regexp_extract(n, rx, 2),
         "kf": F.regexp_extract(n, rx, 3),
         "kx": F.coalesce(F.nullif(F.regexp_extract(n, rx, 4), F.lit("")), F.lit("0")).cast("int")},
        {"kd": F.coalesce(F.nullif(F.ltrim(F.concat(ref("ki"), ref("kf")), F.lit("0")), F.lit("")), F.lit("0")),
         "ke": ref("kx") - F.length(ref("kf"))},
    ]
    digits, exp = ref("kd"), ref("ke")
    adjusted = exp + F.length(digits) - 1
    point = F.length(digits) + exp  # position of the point within digits
    plain_form = (
        F.when(exp == 0, digits)
        .when(point > 0, F.concat(F.substr(digits, F.lit(1), point), F.lit("."),
                                  F.substr(digits, point + 1, -exp)))
        .otherwise(F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits))
    )
    sci_form = F.concat(
        F.substr(digits, F.lit(1), F.lit(1)),
        F.when(F.length(digits) > 1, F.concat(F.lit("."), F.substr(digits, F.lit(2), F.length(digits))))
        .otherwise(F.lit("")),
        F.lit("E"), F.when(adjusted >= 0, F.lit("+")).otherwise(F.lit("-")),
        F.abs(adjusted).cast("string"),
    )
    body = F.when((exp <= 0) & (adjusted >= -6), plain_form).otherwise(sci_form)
    return stages, F.concat(ref("ks"), body)


def python_float_text_stages(ref: Ref, d: Column) -> tuple[list[dict[str, Column]], Column]:
    """``repr(float)`` of a double: shortest digits, fixed notation for
    1e-4 <= |x| < 1e16, otherwise ``d.ddde+XX``. Built from Spark's own
    shortest-digit text (``0.05``, ``1.0E-5``, ``NaN``, ``Infinity``)."""
    rx = r"^(-?)([0-9]+)\.([0-9]+)(?:E(-?[0-9]+))?$"
    stages = [
        {"j": d.cast("string")},
        {"js": F.regexp_extract(ref("j"), rx, 1), "ji": F.regexp_extract(ref("j"), rx, 2),
         "jf": F.regexp_extract(ref("j"), rx, 3),
         "jx": F.coalesce(F.nullif(F.regexp_extract(ref("j"), rx, 4), F.lit("")), F.lit("0")).cast("int")},
        {"jl": F.ltrim(F.concat(ref("ji"), ref("jf")), F.lit("0")),
         "jn": F.length(ref("ji")) + F.length(ref("jf"))},
        {"jd": F.rtrim(ref("jl"), F.lit("0")),
         # decimal exponent of the first significant digit
         "je": F.length(ref("ji")) - 1 + ref("jx") - (ref("jn") - F.length(ref("jl")))},
    ]
    digits, x = ref("jd"), ref("je")
    n = F.length(digits)
    head = F.substr(digits, F.lit(1), x + 1)
    fixed_pos = F.concat(
        F.concat(head, F.repeat(F.lit("0"), x + 1 - F.length(head))),
        F.lit("."),
        F.when(n > x + 1, F.substr(digits, x + 2, n)).otherwise(F.lit("0")),
    )
    fixed_neg = F.concat(F.lit("0."), F.repeat(F.lit("0"), -x - 1), digits)
    sci = F.concat(
        F.substr(digits, F.lit(1), F.lit(1)),
        F.when(n > 1, F.concat(F.lit("."), F.substr(digits, F.lit(2), n))).otherwise(F.lit("")),
        F.lit("e"), F.when(x >= 0, F.lit("+")).otherwise(F.lit("-")),
        # two digits at least (lpad would cut a third one off)
        F.when(F.abs(x) < 10, F.lit("0")).otherwise(F.lit("")), F.abs(x).cast("string"),
    )
    body = F.when(x >= 16, sci).when(x >= 0, fixed_pos).when(x >= -4, fixed_neg).otherwise(sci)
    j = ref("j")
    text = (F.when(j == "NaN", F.lit("nan"))
            .when(j == "Infinity", F.lit("inf"))
            .when(j == "-Infinity", F.lit("-inf"))
            .when(digits == "", F.concat(ref("js"), F.lit("0.0")))
            .otherwise(F.concat(ref("js"), body)))
    return stages, text
