"""Text helpers shared by the converters and the masking code."""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F


def _python_whitespace() -> str:
    # The characters Python's str.strip()/int()/float() treat as whitespace.
    # Derived by rule (str.isspace) so it tracks the interpreter's definition.
    return "".join(ch for ch in map(chr, range(sys.maxunicode + 1)) if ch.isspace())


PY_WHITESPACE = _python_whitespace()


def _regex_class_body(chars: str) -> str:
    # \x{h..h} escapes work in both Java regex (Spark) and RE2 (DuckDB).
    return "".join(f"\\x{{{ord(c):X}}}" for c in chars)


WS_CLASS = "[" + _regex_class_body(PY_WHITESPACE) + "]"
"""Regex character class matching one Python whitespace character."""


def column(name: str) -> Column:
    """The column of that very name: dots and backticks in it are no syntax."""
    return F.col("`" + name.replace("`", "``") + "`")


def py_strip(c: Column) -> Column:
    """``str.strip()`` with Python's whitespace set (Spark's trim only removes spaces)."""
    return F.btrim(c, F.lit(PY_WHITESPACE))


def base_name(path: Column) -> Column:
    """Last ``/``-separated part of a path (``''`` for a trailing slash)."""
    return F.element_at(F.split(path, "/"), -1)


def decode_path(path: Column) -> Column:
    """Canonical, decoded form of a file URI, equal for the scan's
    ``_metadata.file_path`` (``file:///x``, percent-encoded) and the file
    index's listing (``file:/x``).

    A plain url_decode would turn a literal ``+`` into a space, so protect it first.
    Paths without a percent sign are not decoded: this runs once per record.
    """
    short = F.startswith(path, F.lit("file:/")) & ~F.startswith(path, F.lit("file://"))
    uri = F.when(short, F.concat(F.lit("file:///"), F.substr(path, F.lit(len("file:/") + 1)))).otherwise(path)
    return F.when(F.contains(uri, F.lit("%")), F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))).otherwise(uri)
