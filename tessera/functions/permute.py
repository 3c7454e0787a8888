"""Keyed permutations of number ranges as Column expressions.

A number below ``size`` is written as ``left * width + right`` and sent through
``ROUNDS`` Feistel rounds over that mixed radix (the two digits change places,
one increased by a hash of the other). ``width`` is chosen such that no more
than ``width`` results lie outside the range; those are sent through again.
Different numbers therefore always get different results.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Half rounds; each changes one of the two digits by a hash of the other.
ROUNDS = 4
#: Passes for results outside the range; the chance of needing more is below ``size ** (-WALKS / 2)``.
WALKS = 12
MAX_SIZE = 1 << 62


def radices(size: int) -> tuple[int, int]:
    """``height, width`` with ``size <= height * width < size + width``."""
    if not 0 < size <= MAX_SIZE:
        raise ValueError(f"a range of {size} numbers cannot be permuted")
    width = math.isqrt(size - 1) + 1
    return -(-size // width), width


def walks(size: int) -> int:
    """Passes that are made at most: no more than there are numbers outside the range, plus one."""
    height, width = radices(size)
    return min(height * width - size + 1, WALKS)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _below(key: str, number: int, digit: Column, base: int) -> Column:
    """A hash of ``digit`` below ``base``."""
    h = F.md5(F.concat(F.lit(f"{key}:{number}:"), digit.cast("string")))
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("bigint") % F.lit(base).cast("bigint")


def _half_round(k: int, size: int, key: str) -> Callable[[Column], Column]:
    """One digit increased by a hash of the other."""
    height, width = radices(size)

    def turn(p: Column) -> Column:
        left, right = p.getField("left"), p.getField("right")
        if k % 2:
            right = (right + _below(key, k, left, width)) % F.lit(width).cast("bigint")
        else:
            left = (left + _below(key, k, right, height)) % F.lit(height).cast("bigint")
        return F.struct(left.alias("left"), right.alias("right"))
    return turn


def _once(x: Column, size: int, key: str) -> Column:
    width = F.lit(radices(size)[1]).cast("bigint")
    pair = F.struct(F.call_function("div", x, width).alias("left"), (x % width).alias("right"))
    for k in range(ROUNDS):
        pair = _let(pair, _half_round(k, size, key))
    return _let(pair, lambda p: p.getField("left") * width + p.getField("right"))


def permuted(value: Column, size: int, key: str) -> Column:
    """``value`` (a bigint from 0 to ``size - 1``) under the permutation that
    ``key`` chooses; null outside the range."""
    def step(a: Column) -> Column:
        return _let(_once(a.getField("at"), size, key), lambda r: F.struct(r.alias("at"), (r >= size).alias("on")))

    walked = F.aggregate(F.sequence(F.lit(1), F.lit(walks(size))), F.struct(value.cast("bigint").alias("at"), F.lit(True).alias("on")),
                         lambda a, _: F.when(a.getField("on"), step(a)).otherwise(a),
                         lambda a: F.when(~a.getField("on"), a.getField("at")))
    return F.when((value >= 0) & (value < size), walked)
