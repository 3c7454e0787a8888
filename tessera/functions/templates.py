"""Templates of masked values, compiled to Column expressions.

A template is a text in which

* ``#`` stands for a digit, ``@`` for a capital letter, ``?`` for a small one,
* ``[a|b|c]`` for one of the words listed, ``[3-120]`` for a number of the range,
* ``{name}`` for the value of a generator (``{firstname}``, ``{city}``, ...),
* ``\\`` takes the next character as it is; all other characters stand for themselves.

Every choice draws its own number from the hash of the row's key, so the same
key gives the same value in every task, and SQL can derive it.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS, SMALL, CAPITALS = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_CLASSES = {"#": DIGITS, "@": CAPITALS, "?": SMALL}
_TOKEN = re.compile(r"\\(?P<escaped>.)|(?P<one>[#@?])|\[(?P<choice>[^\]]*)\]|\{(?P<name>[^}]*)\}|(?P<bad>[\[\]{}\\])|(?P<text>[^\\#@?\[\]{}]+)", re.S)
_RANGE = re.compile(r"(\d+)-(\d+)\Z")


@dataclass(frozen=True)
class Part:
    """A piece of a template: ``kind`` text, class, choice, range or name."""
    kind: str
    value: object


def parse_template(template: str) -> list[Part]:
    parts: list[Part] = []
    for token in _TOKEN.finditer(template):
        kind, text = token.lastgroup, token[token.lastgroup]
        if kind == "bad":
            raise ValueError(f"template {template!r} has a stray {text!r}")
        if kind in ("text", "escaped"):
            if parts and parts[-1].kind == "text":
                parts[-1] = Part("text", parts[-1].value + text)
            else:
                parts.append(Part("text", text))
        elif kind == "one":
            parts.append(Part("class", _CLASSES[text]))
        elif kind == "name":
            parts.append(Part("name", text))
        elif bounds := _RANGE.match(text):
            low, high = int(bounds[1]), int(bounds[2])
            if low > high:
                raise ValueError(f"template {template!r} has an empty range {text!r}")
            parts.append(Part("range", (low, high)))
        else:
            words = tuple(text.split("|"))
            if not all(words):
                raise ValueError(f"template {template!r} has an empty choice")
            parts.append(Part("choice", words))
    return parts


def draw(h: Column, i: int) -> Column:
    """The i-th 32-bit number of the key's hash, of which there are any number:
    four of ``h`` itself, four of the digest of ``h`` and 1, and so on."""
    block, place = divmod(i, 4)
    digest = h if not block else F.md5(F.concat(h, F.lit(f":{block}")))
    return F.conv(F.substring(digest, 1 + 8 * place, 8), 16, 10).cast("bigint")


def fill_template(template: str, h: Column, named: Callable[[str, Column], Column]) -> Column:
    """The template's value for the key hash ``h``; ``named`` builds the value
    of a generator from a hash of its own."""
    out: list[Column] = []
    for i, part in enumerate(parse_template(template)):
        if part.kind == "text":
            out.append(F.lit(part.value))
        elif part.kind == "class":
            out.append(F.substring(F.lit(part.value), (draw(h, i) % len(part.value) + 1).cast("int"), F.lit(1)))
        elif part.kind == "range":
            low, high = part.value
            out.append((F.lit(low).cast("bigint") + draw(h, i) % (high - low + 1)).cast("string"))
        elif part.kind == "choice":
            out.append(F.element_at(F.array(*(F.lit(w) for w in part.value)), (draw(h, i) % len(part.value) + 1).cast("int")))
        else:
            out.append(named(part.value, F.md5(F.concat(h, F.lit(f"/{i}")))))
    return F.concat(*out) if out else F.lit("")
