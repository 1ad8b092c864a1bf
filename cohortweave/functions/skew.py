"""Lookup joins that stay balanced when one key holds a large share of the rows.

Adaptive execution splits a heavy partition of the facts as long as both join inputs are
plain shuffles. A lookup side that was just aggregated or ranked by the join key has
none of its own, because its rows already lie where they are needed; joining on an expression
over the key makes Spark shuffle it once more. It has one row per key, so that is cheap, and
no key has to be counted, listed or repeated beforehand.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(facts: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join ``facts`` to ``lookup`` (at most one row per key), ``how`` in left / inner / left_anti.

    NULL keys match nothing, as in any join by column.
    """
    if how not in ("left", "inner", "left_anti"):
        raise ValueError(f"Unsupported lookup join type: {how}")
    keys = list(keys)
    named = lookup.selectExpr(
        *[f"concat(cast(`{k}` AS string), '') AS `_at_{k}`" for k in keys],
        *[f"`{c}`" for c in lookup.columns if c not in keys and how != "left_anti"],
    )
    match = F.expr(" AND ".join(f"concat(cast(`{k}` AS string), '') = `_at_{k}`" for k in keys))
    joined = facts.join(named, match, how)
    return joined if how == "left_anti" else joined.drop(*[f"_at_{k}" for k in keys])
