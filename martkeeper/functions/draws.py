"""Deterministic draws: a value depends on (key, purpose) only, never on partitioning or order.

A lost task therefore regenerates the same rows. The digest is MD5 because other SQL engines
compute it identically, which lets the generated tables be checked from outside Spark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from martkeeper.functions.calc import col

SPAN = 2**32


def draw(key: str | Column, purpose: str) -> Column:
    """Integer in [0, 2^32) from the first eight hex digits of the digest."""
    digest = F.md5(F.concat_ws(":", col(key).cast("string"), F.lit(purpose)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def int_between(key: str | Column, purpose: str, low: int, high: int) -> Column:
    """Uniform integer in [low, high], both included."""
    return (F.lit(low) + F.pmod(draw(key, purpose), F.lit(high - low + 1))).cast("int")


def cents_between(key: str | Column, purpose: str, low: int, high: int) -> Column:
    """Uniform amount in [low, high] with two digits."""
    steps = (high - low) * 100 + 1
    return (F.lit(low * 100) + F.pmod(draw(key, purpose), F.lit(steps))).cast("double") / 100


def choose(key: str | Column, purpose: str, values: Sequence[str]) -> Column:
    """Uniform choice from a list."""
    slot = F.pmod(draw(key, purpose), F.lit(len(values))).cast("int") + 1
    return F.element_at(F.array(*[F.lit(v) for v in values]), slot)


def choose_weighted(key: str | Column, purpose: str, weights: dict[str, int]) -> Column:
    """Choice with integer weights, by position of a uniform draw on their running sum."""
    total = sum(weights.values())
    point = F.pmod(draw(key, purpose), F.lit(total))
    names = list(weights)
    out, reached = None, 0
    for name in names[:-1]:
        reached += weights[name]
        hit = point < reached
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(names[-1]) if out is not None else F.lit(names[-1])


def chance(key: str | Column, purpose: str, percent: int) -> Column:
    """True for ``percent`` of the keys."""
    return F.pmod(draw(key, purpose), F.lit(100)) < percent


def padded_key(prefix: str, number: str | Column, width: int = 6) -> Column:
    """Zero-padded key such as ``PAT-000042``; longer numbers are kept whole."""
    digits = col(number).cast("bigint").cast("string")
    padded = F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0"))
    return F.concat(F.lit(f"{prefix}-"), padded)
