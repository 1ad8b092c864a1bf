"""Quality rules: text statistics in SQL and a learned decision list of threshold conjunctions.

Sequential covering: a rule grows one threshold at a time from counts per statistic, value
bin and label; it is pruned on labelled rows it was not grown on; the rows it covers leave
the table of the next rule. Only those counts reach the driver: their number is bounded by
statistics times bins. The list is applied as one ordered CASE expression.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortweave.llm.blocks import stored

# White space and symbol characters of the statistics.
SPACE = r"\\x20\\x09-\\x0D"
SYMBOLS = "#*$%&|<>"

WINDOW = 5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_bang", "n_distinct")

# Statistics a rule may test, from the counts.
STATISTICS = {
    "words": "cast(n_words AS double)",
    "mean_word": "word_chars / greatest(n_words, 1)",
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "bang_share": "n_bang / greatest(word_chars, 1)",
    "distinct_share": "n_distinct / greatest(n_words, 1)",
}


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    threshold: float

    def sql(self) -> str:
        return f"{self.statistic} {'>=' if self.above else '<'} {self.threshold!r}D"


@dataclass(frozen=True)
class Rule:
    """Reject when all conditions hold; ``hits`` and ``misses`` are labelled rows it was pruned on."""

    conditions: tuple[Condition, ...]
    hits: int
    misses: int

    def sql(self) -> str:
        return " AND ".join(c.sql() for c in self.conditions)


def text_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """``key``, the columns ``carry`` and the counts of each row's whole text; NULL text: all 0.

    ``n_repeat_words`` counts the words inside any five-word window that occurs twice or more
    in the text. Windows are compared by a 64-bit hash of their words. Every step works
    inside the row and takes n log n time in its number of words.
    """
    rows = docs.selectExpr(f"`{key}` AS _key", *[f"`{c}` AS `_c_{i}`" for i, c in enumerate(carry)], f"coalesce(cast(`{text}` AS string), '') AS _text")
    kept = ["_key", *[f"_c_{i}" for i in range(len(carry))]]
    rows = rows.selectExpr(
        *kept,
        f"array_remove(split(_text, '[{SPACE}]+'), '') AS _w",
        f"filter(split(_text, '\\n'), x -> x rlike '[^{SPACE}]') AS _l",
        f"length(regexp_replace(_text, '[{SPACE}]+', '')) AS word_chars",
        f"length(regexp_replace(_text, '[^{SYMBOLS}]+', '')) AS n_symbols",
        "length(regexp_replace(_text, '[^\\\\p{Lu}]+', '')) AS n_upper",
        "length(regexp_replace(_text, '[^!?]+', '')) AS n_bang",
    )
    plain = ["word_chars", "n_symbols", "n_upper", "n_bang"]
    window = ", ".join(f"_w[i + {k}]" for k in range(WINDOW))
    rows = rows.selectExpr(
        *kept,
        *plain,
        "size(_w) AS n_words",
        "size(array_distinct(_w)) AS n_distinct",
        "size(_l) AS n_lines",
        "size(_l) - size(array_distinct(_l)) AS n_dup_lines",
        f"CASE WHEN size(_w) >= {WINDOW} THEN transform(sequence(0, size(_w) - {WINDOW}), i -> xxhash64({window})) ELSE array() END AS _h",
    )
    counts = [*plain, "n_words", "n_distinct", "n_lines", "n_dup_lines"]
    # Only texts with a repeated window are ordered; equal windows are then neighbours.
    rows = rows.selectExpr(
        *kept,
        *counts,
        "CASE WHEN size(array_distinct(_h)) < size(_h) THEN array_sort(transform(_h, (x, i) -> struct(x AS h, i AS i))) ELSE array() END AS _z",
    ).selectExpr(
        *kept,
        *counts,
        "array_sort(filter(transform(_z, (e, j) -> if((j > 0 AND get(_z, j - 1).h = e.h) OR get(_z, j + 1).h = e.h, e.i, -1)), x -> x >= 0)) AS _p",
    )
    return rows.selectExpr(
        f"_key AS `{key}`",
        *[f"_c_{i} AS `{c}`" for i, c in enumerate(carry)],
        *[f"cast({c} AS bigint) AS {c}" for c in COUNTS if c != "n_repeat_words"],
        "cast(CASE WHEN size(_p) = 0 THEN 0 ELSE "
        f"{WINDOW} + aggregate(transform(_p, (x, k) -> if(k = 0, 0, least({WINDOW}, x - get(_p, k - 1)))), 0, (a, x) -> a + x) END AS bigint) AS n_repeat_words",
    )


def with_statistics(counts: DataFrame) -> DataFrame:
    """Add the statistics of ``STATISTICS`` to rows with the counts."""
    return counts.selectExpr("*", *[f"{sql} AS {name}" for name, sql in STATISTICS.items()])


def learn(
    labelled: DataFrame,
    bad: str,
    fold_key: str,
    bins: int = 64,
    max_rules: int = 12,
    max_conditions: int = 4,
    min_precision: float = 0.95,
) -> list[Rule]:
    """Decision list for ``bad`` (boolean SQL) from all rows of ``labelled`` (with statistics).

    A third of the rows, by a hash of ``fold_key``, is held back for pruning. Learning ends when the
    next rule is right on less than ``min_precision`` of the held-back rows it covers, or covers
    too few of them to tell (a smoothed share under 0.9). Rows with an unknown label are ignored; no rows or one class give an empty list.
    """
    names = list(STATISTICS)
    rows = labelled.selectExpr(
        *names, f"({bad}) AS _bad", f"pmod(xxhash64(cast(`{fold_key}` AS string)), 3) = 0 AS _prune"
    ).filter("_bad IS NOT NULL")
    steps = ", ".join(f"{i / bins!r}D" for i in range(bins + 1))
    edges_row = rows.groupBy("_bad").agg(*[F.expr(f"percentile_approx({n}, array({steps}), 10000) AS {n}") for n in names]).collect()
    if len(edges_row) < 2:
        return []
    edges = {n: sorted({float(x) for r in edges_row for x in r[n] or () if x is not None and not math.isnan(x)}) for n in names}
    # Bin k of a statistic holds values from edge k - 1 (inclusive) to edge k.
    binned = stored(
        rows.selectExpr(
            "_bad", "_prune", *names, *[f"size(filter(array({', '.join(f'{e!r}D' for e in edges[n])}), e -> e <= {n})) AS _b_{n}" for n in names]
        ),
        "rule-bins",
    )
    stack = ", ".join(f"struct('{n}' AS name, _b_{n} AS bin)" for n in names)
    rules: list[Rule] = []
    while len(rules) < max_rules:
        left = binned
        for rule in rules:
            left = left.filter(f"NOT ({rule.sql()})")
        conditions = _grow(left.filter("NOT _prune"), stack, edges, max_conditions)
        if not conditions:
            break
        rule = _prune(left.filter("_prune"), conditions)
        covered = rule.hits + rule.misses
        if rule.hits < min_precision * covered or rule.hits + 1 < 0.9 * (covered + 2):  # the second: too few to tell
            break
        rules.append(rule)
    return rules


def _grow(rows: DataFrame, stack: str, edges: dict[str, list[float]], most: int) -> list[Condition]:
    """Add the condition of largest information gain until only bad rows are covered."""
    conditions: list[Condition] = []
    while len(conditions) < most:
        covered = rows
        for c in conditions:
            covered = covered.filter(c.sql())
        table = (
            covered.selectExpr("_bad", f"inline(array({stack}))")
            .groupBy("name", "bin")
            .agg(F.expr("count_if(_bad) AS p"), F.expr("count_if(NOT _bad) AS n"))
            .collect()
        )
        by_name: dict[str, dict[int, tuple[int, int]]] = {}
        for r in table:
            by_name.setdefault(r["name"], {})[r["bin"]] = (r["p"], r["n"])
        if not by_name:
            break
        first = next(iter(by_name.values()))
        p0, n0 = sum(p for p, _ in first.values()), sum(n for _, n in first.values())
        if p0 == 0 or n0 == 0:
            break
        best: tuple[float, Condition] | None = None
        for name in sorted(by_name):
            below_p = below_n = 0
            for k, edge in enumerate(edges[name]):
                p, n = by_name[name].get(k, (0, 0))
                below_p, below_n = below_p + p, below_n + n
                for above, hit, miss in ((True, p0 - below_p, n0 - below_n), (False, below_p, below_n)):
                    if hit:
                        gain = hit * (math.log2(hit / (hit + miss)) - math.log2(p0 / (p0 + n0)))
                        if best is None or gain > best[0] + 1e-9:
                            best = gain, Condition(name, above, edge)
        if best is None or best[0] <= 0 or best[1] in conditions:
            break
        conditions.append(best[1])
    return conditions


def _prune(rows: DataFrame, conditions: list[Condition]) -> Rule:
    """The leading conditions with the best balance of hits and misses on held-back rows."""
    prefixes = [" AND ".join(c.sql() for c in conditions[: k + 1]) for k in range(len(conditions))]
    found = rows.agg(
        *[F.expr(f"count_if(_bad AND {s}) AS p{k}") for k, s in enumerate(prefixes)],
        *[F.expr(f"count_if(NOT _bad AND {s}) AS n{k}") for k, s in enumerate(prefixes)],
    ).first()
    best = max(range(len(conditions)), key=lambda k: ((found[f"p{k}"] - found[f"n{k}"]) / max(1, found[f"p{k}"] + found[f"n{k}"]), -k))
    return Rule(tuple(conditions[: best + 1]), found[f"p{best}"], found[f"n{best}"])


def verdict(rules: Sequence[Rule]) -> Column:
    """Number of the first rule that rejects a row with statistics, NULL when none does."""
    if not rules:
        return F.expr("cast(NULL AS int)")
    return F.expr("CASE " + " ".join(f"WHEN {r.sql()} THEN {i}" for i, r in enumerate(rules, 1)) + " END")


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", quality: str = "quality") -> DataFrame:
    """Counts, statistics, ``base_failed``, ``rule`` (first rejecting rule or NULL) and ``kept`` per row of ``docs``.

    The list is learned from all rows of ``docs`` that ``labels`` marks (0: bad, 1: good; other marks are
    ignored; several marks of a key: the lowest). Without usable labels only the base rule rejects.
    NULL and blank texts fail the base rule. Repeated rows are judged alike; a NULL key has no label.
    """
    counted = stored(text_counts(docs, key, text), "rule-counts")
    rows = with_statistics(counted)
    marks = labels.selectExpr(f"`{key}` AS _mark_key", f"`{quality}` AS _mark").filter("_mark IN (0, 1)").groupBy("_mark_key").agg(F.min("_mark").alias("_mark"))
    rules = learn(rows.join(marks, rows[key] == marks["_mark_key"]), "_mark = 0", key)
    base = "n_words < 10 OR 100 * n_repeat_words > 20 * n_words"
    return (
        rows.withColumn("base_failed", F.expr(base))
        .withColumn("rule", verdict(rules))
        .withColumn("kept", F.expr("NOT base_failed AND rule IS NULL"))
    )
