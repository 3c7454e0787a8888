"""Masking operators: by column type (M1-M15, V1-V3) and by key.

Both build one ``select``: every output column is either the input column or
a native expression, so masking a table is a single narrow stage with no
Python in the executors and no shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import mask as gen
from ..functions.text import WS_CLASS, column

# Mask types usable in a column config (M1-M14), and the meta keys they read.
TYPES = {
    "firstname": "gender_column_name",
    "lastname": "gender_column_name",
    "date_of_birth": None,
    "street_number": None,
    "street_name": None,
    "street_suffix": None,
    "city": None,
    "state": None,
    "zip_code": None,
    "email": None,
    "phone_number": None,
    "contact_details": "contact_type_column_name",
    "account_number": None,
    "drivers_license": None,
}

# How a keyed-mask provider recognizes a value's shape
# (matched at the start of the value, like Python's re.match).
EMAIL_CHECK = r"[^@]+@[^@]+\.[^@]+"
PHONE_CHECK = r"[\s0-9]+"
# Separators used when the reference joins lookup names and lookup values.
LOOKUP_NAME_SEP = "."
LOOKUP_VALUE_SEP = "#~"
SEP_KEY = "/"


def phone_check_regex() -> str:
    # PHONE_CHECK at the start of the value; its \s is Python's (Unicode) whitespace.
    return "^(?:" + WS_CLASS + "|[0-9])+"


# --- validation (V1-V3) ---------------------------------------------------------

class MaskConfigError(RuntimeError):
    """All that is wrong with a mask configuration."""

    def __init__(self, problems: list[str]):
        super().__init__("mask configuration: " + "; ".join(problems))
        self.problems = problems


def config_problems(config: Mapping, columns: list[str]) -> list[str]:
    """V1-V3: what is wrong with ``config`` for a table with these columns."""
    found: list[str] = []
    known = set(columns)
    for target, entry in config.items():
        entry = entry or {}
        needed = {target} | {v for k, v in (entry.get("meta") or {}).items() if k.endswith("column_name")}
        found += [f"{target!r} needs column {c!r}, which the table lacks" for c in sorted(needed - known, key=str)]
        if entry.get("type") not in TYPES:
            found.append(f"{target!r} has the unknown mask type {entry.get('type')!r}")
        elif entry["type"] == "contact_details" and not (entry.get("meta") or {}).get(TYPES["contact_details"]):
            found.append(f"{target!r} needs meta {TYPES['contact_details']!r}")
    return found


def validate_config(config: Mapping, columns: list[str]) -> None:
    """V1: every configured column exists; V2: its type is known; V3: every
    ``meta`` key ending in ``column_name`` names an existing column."""
    if problems := config_problems(config, columns):
        raise MaskConfigError(problems)


def _salted(salt: str) -> str:
    # without a secret the masks of guessed values can be recomputed by anyone
    if not isinstance(salt, str) or not salt:
        raise ValueError("masking needs a salt that is not empty")
    return salt


# --- by type (M1-M15) -------------------------------------------------------------

def type_mask(type_name: str, h: Column, column_config: Mapping, current: Mapping[str, Column]) -> Column:
    """Expression for one configured column; ``current`` maps column names to
    their expressions so far (a later column sees earlier masked values)."""
    meta = column_config.get("meta") or {}
    meta_key = TYPES[type_name]
    if type_name == "contact_details":
        return gen.contact_details(h, current[meta[meta_key]])
    if meta_key and meta.get(meta_key):
        return gen.generate(type_name, h, gender=current[meta[meta_key]])
    return gen.generate(type_name, h)


def apply_mask_config(df: DataFrame, config: Mapping, *, salt: str,
                      key_columns: Mapping[str, list[str]] | None = None,
                      validate: bool = True) -> DataFrame:
    """Mask the configured columns in config order, in one projection.

    The replacement for a column is chosen by hashing ``salt``, the type, the
    column name and the row key: by default the column's own value (so equal
    values mask equally), or the columns listed in ``key_columns[column]``.
    """
    _salted(salt)
    if validate:
        validate_config(config, df.columns)
    if missing := {k for keys in (key_columns or {}).values() for k in keys} - set(df.columns):
        raise MaskConfigError([f"key column {c!r} is not in the table" for c in sorted(missing)])
    current: dict[str, Column] = {c: column(c) for c in df.columns}
    for column_name, column_config in config.items():
        type_name = column_config["type"]
        keys = (key_columns or {}).get(column_name)
        parts = [current[k] for k in keys] if keys else [current[column_name]]
        h = gen.key_hash(salt, type_name, column_name, *parts)
        current[column_name] = type_mask(type_name, h, column_config, current)
    return df.select(*[current[c].alias(c) for c in df.columns])


# --- by key (M16-M19) ----------------------------------------------------------------

def _provider_matches(provider: Mapping, value: Column) -> Column | None:
    vtype = provider.get("ValueType")
    if vtype == "Email":
        return value.rlike("^(?:" + EMAIL_CHECK + ")")
    if vtype == "Phone":
        return value.rlike(phone_check_regex())
    if vtype == "All":
        return F.lit(True)
    return None  # never matches


def _provider_value(provider: Mapping, column_name: str, value: Column, lookups: list[str],
                    salt: str) -> Column:
    function = provider.get("Function")
    if not function:
        return value  # M19: provider without a function leaves the value
    kwargs = provider.get("MockKwargs") or {}
    lookup_values = F.concat_ws(LOOKUP_VALUE_SEP, *[F.coalesce(column(c), F.lit("")) for c in lookups]) \
        if lookups else F.lit("")
    h = gen.key_hash(salt, str(function), gen.kwargs_text(kwargs), column_name, value,
                     LOOKUP_NAME_SEP.join(lookups), lookup_values)
    # one permutation per column and arguments: equal numbers of other rows stay equal
    key = SEP_KEY.join((salt, str(function), gen.kwargs_text(kwargs), column_name))
    return gen.generate_from(str(function), h, value, key, **kwargs)


def keyed_mask_column(column_name: str, column_spec: Mapping | None, salt: str) -> Column:
    """M16 + M17 + M18 for one column, from the row's original values."""
    value = column(column_name)
    providers = list((column_spec or {}).get("DataProvider") or [])
    if not providers:
        return value  # M17: empty provider list -> unchanged
    lookups = list((column_spec or {}).get("IdLookup") or [])
    chosen: Column | None = None
    for p in providers:
        cond = _provider_matches(p, value)
        if cond is None:
            continue
        out = _provider_value(p, column_name, value, lookups, salt)
        chosen = F.when(cond, out) if chosen is None else chosen.when(cond, out)
    fallback = _provider_value(providers[-1], column_name, value, lookups, salt)
    masked = fallback if chosen is None else chosen.otherwise(fallback)
    # A null or blank value stays as it is.
    return F.when(value.isNull() | (value == ""), value).otherwise(masked)


def validate_spec(spec: Mapping, columns: list[str]) -> None:
    for name, column_spec in spec.items():
        if name not in columns:
            continue  # configured columns absent from a file are ignored, as by the reference
        for lookup in (column_spec or {}).get("IdLookup") or []:
            if lookup not in columns:
                raise RuntimeError(f"Lookup column {lookup} of {name} not present in data")
        for p in (column_spec or {}).get("DataProvider") or []:
            if p.get("Function"):
                gen.check(str(p["Function"]), p.get("MockKwargs") or {})


def keyed_mask(df: DataFrame, spec: Mapping, *, salt: str,
               passthrough: tuple[str, ...] = ()) -> DataFrame:
    """Mask every column named in ``spec`` (the ``MockColumns`` mapping) by key;
    other columns pass through unchanged (M19). Columns in ``passthrough`` are
    never masked (e.g. source-file bookkeeping columns)."""
    _salted(salt)
    spec = spec.get("MockColumns", spec) if isinstance(spec, Mapping) else spec
    validate_spec(spec, df.columns)
    return df.select(*[
        (keyed_mask_column(c, spec[c], salt) if c in spec and c not in passthrough else column(c)).alias(c)
        for c in df.columns
    ])
