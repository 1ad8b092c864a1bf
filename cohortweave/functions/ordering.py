"""Exact order statistics and running totals without a window over a whole group.

Both work on distinct values with their counts. A value is an order-preserving 63-bit
integer with sign, taken apart into three digits of 21 bits. Totals per leading digit, then per
two leading digits, are summed first, so a window only ever orders the at most 2**21
(with both signs 2**22) successors of one prefix, however close the values lie.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIGIT_BITS = 21


def order_code(value: str) -> str:
    """SQL for a bigint that orders like the finite double ``value``, and is as distinct.

    It is the exponent and the 52 bits of the fraction, with the sign in front. Powers of two are
    exact, so only the estimate of the exponent needs a correction by one.
    """
    size = f"abs({value})"
    estimate = f"greatest(floor(log2({size})), -1022)"
    corrected = (
        f"CASE WHEN pow(2D, {estimate}) > {size} THEN greatest({estimate} - 1, -1022) "
        f"WHEN {estimate} < 1023 AND pow(2D, {estimate} + 1) <= {size} THEN {estimate} + 1 ELSE {estimate} END"
    )
    code = (
        f"transform(array({corrected}), e -> CASE WHEN {size} < pow(2D, -1022) "
        f"THEN cast({size} * pow(2D, 537) * pow(2D, 537) AS bigint) "
        f"ELSE shiftleft(cast(e + 1023 AS bigint), 52) + cast(({size} / pow(2D, e) - 1) * pow(2D, 52) AS bigint) END)[0]"
    )
    # Never NULL, so that no extra filter keeps Spark from sharing the counts' shuffle.
    return f"coalesce(CASE WHEN {value} = 0 THEN 0L WHEN {value} > 0 THEN {code} ELSE -{code} END, 0L)"


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``(keys, value, n)`` for the finite values of rows with complete keys."""
    known = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return (
        df.selectExpr(*keys, f"cast({value} AS double) AS value")
        .filter(f"{known} AND value IS NOT NULL AND NOT isnan(value) AND abs(value) < double('infinity')")
        .groupBy(*keys, "value")
        .agg(F.expr("count(1) AS n"))
    )


def _over(keys: Sequence[str], order: str) -> str:
    """Window over the rows that come strictly earlier."""
    return f"OVER (PARTITION BY {', '.join(keys)} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


def _coded(counts: DataFrame) -> DataFrame:
    """Add the prefixes of one and of two digits, ``_p1`` and ``_p2``."""
    coded = counts.selectExpr("*", f"{order_code('value')} AS _code")
    return coded.selectExpr("*", f"shiftright(_code, {2 * DIGIT_BITS}) AS _p1", f"shiftright(_code, {DIGIT_BITS}) AS _p2").drop("_code")


def running_totals(
    counts: DataFrame, keys: Sequence[str], weights: Sequence[str], descending: bool = False
) -> DataFrame:
    """Add ``<w>_before`` (weight of strictly earlier values) and ``<w>_total`` per key.

    ``counts`` has one row per ``(keys, value)``; keys must not be NULL.
    """
    keys = list(keys)
    way = "DESC" if descending else "ASC"
    coded = _coded(counts)
    sums = [F.expr(f"sum({w}) AS {w}") for w in weights]
    second = coded.groupBy(*keys, "_p1", "_p2").agg(*sums)
    first = second.groupBy(*keys, "_p1").agg(*sums)
    whole = f"OVER (PARTITION BY {', '.join(keys)})"
    starts = first.selectExpr(
        *keys,
        "_p1",
        *[f"coalesce(sum({w}) {_over(keys, f'_p1 {way}')}, 0) AS _{w}_1" for w in weights],
        *[f"sum({w}) {whole} AS {w}_total" for w in weights],
    )
    inner = second.join(starts, [*keys, "_p1"]).selectExpr(
        *keys,
        "_p2",
        *[f"_{w}_1 + coalesce(sum({w}) {_over([*keys, '_p1'], f'_p2 {way}')}, 0) AS _{w}_2" for w in weights],
        *[f"{w}_total" for w in weights],
    )
    inside = _over([*keys, "_p2"], f"value {way}")
    return coded.join(inner, [*keys, "_p2"]).selectExpr(
        *counts.columns,
        *[f"_{w}_2 + coalesce(sum({w}) {inside}, 0) AS {w}_before" for w in weights],
        *[f"{w}_total" for w in weights],
    )


def _at_ranks(counts: DataFrame, keys: Sequence[str], ranks: Sequence[str]) -> DataFrame:
    """Per key a map ``_at`` from wanted rank to value, and the row total ``_total``.

    ``ranks`` are SQL for zero-based ranks and may use ``_total``. Each step orders only the
    successors of prefixes that hold a wanted rank.
    """
    keys = list(keys)
    coded = _coded(counts.selectExpr(*keys, "value", "n"))
    wanted = ", ".join(f"cast({r} AS bigint)" for r in ranks)
    second = coded.groupBy(*keys, "_p1", "_p2").agg(F.expr("sum(n) AS _size"))
    # The lists below hold one entry per wanted rank.
    inside = "filter({ranks}, r -> r >= _start AND r < _start + _size) AS _ranks"
    first = (
        second.groupBy(*keys, "_p1")
        .agg(F.expr("sum(_size) AS _size"))
        .selectExpr(
            *keys,
            "_p1",
            "_size",
            f"coalesce(sum(_size) {_over(keys, '_p1')}, 0) AS _start",
            f"sum(_size) OVER (PARTITION BY {', '.join(keys)}) AS _total",
        )
        .selectExpr(*keys, "_p1", "_start AS _outer", "_total", inside.format(ranks=f"array_distinct(array({wanted}))"))
        .filter("size(_ranks) > 0")
    )
    targets = (
        second.join(first, [*keys, "_p1"])
        .selectExpr(*keys, "_p2", "_size", "_total", "_ranks", f"_outer + coalesce(sum(_size) {_over([*keys, '_p1'], '_p2')}, 0) AS _start")
        .selectExpr(*keys, "_p2", "_start", "_total", inside.format(ranks="_ranks"))
        .filter("size(_ranks) > 0")
    )
    return (
        coded.join(targets, [*keys, "_p2"])
        .selectExpr("*", f"_start + coalesce(sum(n) {_over([*keys, '_p2'], 'value')}, 0) AS _first")
        .selectExpr(
            *keys, "_total", "value", "explode(filter(_ranks, r -> r >= _first AND r < _first + n)) AS _rank"
        )
        .groupBy(*keys)
        .agg(
            F.expr("map_from_entries(collect_list(struct(_rank, value))) AS _at"),
            F.expr("max(_total) AS _total"),
        )
    )


def values_at_ranks(
    counts: DataFrame, keys: Sequence[str], ranks: Sequence[str], names: Sequence[str]
) -> DataFrame:
    """The values at zero-based ranks (SQL, may use the keys), NULL beyond the last row."""
    at = _at_ranks(counts, keys, ranks)
    return at.selectExpr(*keys, *[f"try_element_at(_at, cast({r} AS bigint)) AS {n}" for r, n in zip(ranks, names)])


def percentiles_of_counts(
    counts: DataFrame, keys: Sequence[str], probabilities: Sequence[float], names: Sequence[str]
) -> DataFrame:
    """Exact, linearly interpolated percentiles of ``(keys, value, n)`` counts.

    One row per key with a column per name.
    """
    places = [f"({float(p)!r}D * (_total - 1))" for p in probabilities]
    at = _at_ranks(counts, keys, [f"{side}({p})" for p in places for side in ("floor", "ceil")])

    def interpolated(place: str) -> str:
        low = f"try_element_at(_at, cast(floor({place}) AS bigint))"
        high = f"try_element_at(_at, cast(ceil({place}) AS bigint))"
        return f"{low} + ({high} - {low}) * ({place} - floor({place}))"

    return at.selectExpr(*keys, *[f"{interpolated(p)} AS {n}" for p, n in zip(places, names)])


def exact_percentiles(
    df: DataFrame, keys: Sequence[str], value: str, probabilities: Sequence[float], names: Sequence[str]
) -> DataFrame:
    return percentiles_of_counts(value_counts(df, keys, value), keys, probabilities, names)
