"""The many-to-one join of facts to one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach(
    facts: DataFrame,
    attributes: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    null_safe: bool = False,
) -> DataFrame:
    """Facts with the attributes of their key; ``attributes`` has one row per key.

    ``null_safe`` lets a NULL key match the attributes of the NULL key, as a window would. Keys are
    compared as in any join: types are brought to a common one, so 1 meets 1.0 and 0.0 meets -0.0.

    Attributes often come from an aggregate or window over the same key, so Spark would reuse that
    partitioning and shuffle the facts only. Adaptive execution splits a skewed partition only
    where both sides of the join come straight from a shuffle of their own. The join therefore also
    compares whether the first key is NULL, which follows from the keys and so changes no result,
    but gives both sides a shuffle on one key more. That costs a shuffle of the smaller side and
    lets a key with a large share of the facts be spread over many tasks. A side that turns out to
    be small is broadcast instead, as in any join.
    """
    renamed = {k: f"_key{i}" for i, k in enumerate(keys)}
    own = attributes.select(
        F.isnull(keys[0]).alias("_key_missing"),
        *[F.col(k).alias(new) for k, new in renamed.items()],
        *[F.col(c) for c in attributes.columns if c not in renamed],
    )
    condition = F.isnull(keys[0]) == F.col("_key_missing")
    for k, new in renamed.items():
        left, right = F.col(k), F.col(new)
        condition = condition & (left.eqNullSafe(right) if null_safe else left == right)
    return facts.join(own, condition, how).drop("_key_missing", *renamed.values())
