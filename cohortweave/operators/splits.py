"""Train / validation / test assignment.

A random split ranks rows by a hash of patient id and seed. Only the cut-off hash
of each class is looked for, exactly, and rows are then assigned by comparing with
at most four constants: no row-level sort, and no shuffle of the rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.config import ModelConfig
from cohortweave.functions.ordering import values_at_ranks

SPLIT = "_split"
SPLIT_NAMES = ("train", "val", "test")
_RANDOM_NOTE = "random train validation test split was created"
_SUPPORT_NOTE = "stratified split skipped because class support was insufficient"


def existing_split(df: DataFrame, split: str) -> DataFrame:
    """Assignment read from a column; other values belong to no split."""
    word = f"lower(cast(`{split}` AS string))"
    return df.withColumn(
        SPLIT,
        F.expr(
            f"""CASE WHEN {word} = 'train' THEN 'train'
                     WHEN {word} IN ('val', 'valid', 'validation') THEN 'val'
                     WHEN {word} = 'test' THEN 'test' END"""
        ),
    )


def split_counts(assigned: DataFrame) -> dict[str, int]:
    """Rows per split; three numbers."""
    row = assigned.agg(*[F.expr(f"count_if({SPLIT} = '{s}') AS {s}") for s in SPLIT_NAMES]).first()
    return {s: row[s] for s in SPLIT_NAMES}


def allocate(class_counts: list[int], draws: int) -> list[int]:
    """Share ``draws`` over classes in proportion, remainders to the largest fractions."""
    total = sum(class_counts)
    exact = [c * draws / total for c in class_counts]
    shares = [math.floor(e) for e in exact]
    by_fraction = sorted(range(len(exact)), key=lambda k: (shares[k] - exact[k], k))
    for k in by_fraction[: draws - sum(shares)]:
        shares[k] += 1
    return shares


def holdout_quota(class_counts: list[int], fraction: float, stratify: bool) -> list[int]:
    """Held-out rows per class; one class stands for everything when not stratified."""
    total = sum(class_counts)
    held = math.ceil(fraction * total)
    kept = total - held
    if kept <= 0 or held <= 0:
        raise ValueError("the resulting split would be empty")
    if not stratify:
        return [held]
    for name, size in (("test", held), ("train", kept)):
        if size < len(class_counts):
            raise ValueError(
                f"The {name}_size = {size} should be greater or equal to the number of classes = {len(class_counts)}"
            )
    return [c - k for c, k in zip(class_counts, allocate(class_counts, kept))]


def random_split(df: DataFrame, config: ModelConfig = ModelConfig()) -> tuple[DataFrame, list[str]]:
    """Seeded split with exact sizes, stratified by the binary target where possible."""
    notes = [_RANDOM_NOTE]
    target = f"cast(`{config.target}` AS int)"
    row = df.agg(F.expr(f"count_if({target} = 0) AS n0"), F.expr(f"count_if({target} = 1) AS n1")).first()
    counts = [row.n0, row.n1]
    if config.fused and sum(counts) < 5:
        notes.append("dataset was too small for separate validation and test splits")
        return df.withColumn(SPLIT, F.lit("train")), notes

    def stratified(current: list[int]) -> bool:
        if not config.stratify:
            return False
        if min(current) < 2:
            notes.append(_SUPPORT_NOTE)
            return False
        return True

    by_class = stratified(counts)
    try:
        test = holdout_quota(counts, config.test_size, by_class)
    except ValueError as error:
        if not config.fused:
            raise
        notes.append(f"test split stratification skipped: {error}")
        by_class = False
        test = holdout_quota(counts, config.test_size, False)
    groups = counts if by_class else [sum(counts)]
    left = [g - t for g, t in zip(groups, test)]
    # Without test strata the class counts of the rest are not known in advance; the
    # validation rows then come from the same single ranking.
    rest_by_class = by_class and stratified(left)
    try:
        val = holdout_quota(left, config.val_size / (1.0 - config.test_size), rest_by_class)
        if by_class and not rest_by_class:
            val = allocate(left, val[0])
    except ValueError as error:
        if not config.fused:
            raise
        notes.append(f"validation split skipped: {error}")
        val = [0] * len(groups)
    return _assign(df, config, test, val, by_class), list(dict.fromkeys(notes))


def _assign(df: DataFrame, config: ModelConfig, test: list[int], val: list[int], by_class: bool) -> DataFrame:
    # 53 bits of the hash, so that a double holds it exactly.
    rank = f"cast(shiftrightunsigned(xxhash64(cast(`{config.patient_id}` AS string), {int(config.seed)}L), 11) AS double)"
    group = f"cast(`{config.target}` AS int)" if by_class else "0"
    ranked = df.selectExpr("*", f"{rank} AS _rank_hash", f"{group} AS _class")

    def per_class(sizes: list[int]) -> str:
        if not by_class:
            return str(sizes[0])
        return f"CASE WHEN _class = 1 THEN {sizes[1]} ELSE {sizes[0]} END"

    counts = ranked.groupBy("_class", F.col("_rank_hash").alias("value")).agg(F.expr("count(1) AS n"))
    both = [t + v for t, v in zip(test, val)]
    cuts = values_at_ranks(
        counts,
        ["_class"],
        [f"({per_class(test)}) - 1", f"({per_class(both)}) - 1"],
        ["test_cut", "val_cut"],
    ).collect()  # one row per class, at most two
    branches = []
    for cut in cuts:
        for name, value in (("test", cut.test_cut), ("val", cut.val_cut)):
            if value is not None:
                branches.append(f"WHEN _class = {cut['_class']} AND _rank_hash <= {value!r}D THEN '{name}'")
    rule = f"CASE {' '.join(branches)} ELSE 'train' END" if branches else "'train'"
    return ranked.withColumn(SPLIT, F.expr(rule)).drop("_rank_hash", "_class")


def split_audit(first: DataFrame, again: DataFrame, key: str, stratum: str) -> DataFrame:
    """Per stratum and split: rows, rows whose key is in another split too, and whether a second run agrees.

    A split's rows are summed into a fingerprint that does not depend on their order: the sum of hashes of
    their keys. Two runs agree where the fingerprints do. ``stratum_fingerprint`` is that of all splits of the stratum.
    """

    def prints(df: DataFrame, name: str) -> DataFrame:
        value = f"cast(conv(substr(md5(cast(cast(`{key}` AS string) AS binary)), 1, 8), 16, 10) AS bigint)"
        return df.groupBy(F.col(stratum).alias("stratum"), F.col(SPLIT).alias("split")).agg(
            F.expr(f"count(1) AS {name}_rows"), F.expr(f"sum({value}) AS {name}")
        )

    places = first.groupBy(F.col(key).alias("_key")).agg(F.expr(f"min({SPLIT}) AS a"), F.expr(f"max({SPLIT}) AS b"))
    shared = places.filter("a <> b").select("_key")
    both = first.join(shared, F.col(key) == F.col("_key"), "left_semi").groupBy(F.col(stratum).alias("stratum"), F.col(SPLIT).alias("split"))
    found = prints(first, "row_count").withColumnsRenamed({"row_count": "fingerprint", "row_count_rows": "row_count"})
    joined = found.join(prints(again, "other"), ["stratum", "split"], "full").join(
        both.agg(F.expr("count(1) AS shared_rows")), ["stratum", "split"], "left"
    )
    return joined.selectExpr(
        "stratum",
        "split",
        "coalesce(row_count, 0) AS row_count",
        "coalesce(shared_rows, 0) AS shared_rows",
        "fingerprint <=> other AND row_count <=> other_rows AS repeatable",
        "sum(fingerprint) OVER (PARTITION BY stratum) AS stratum_fingerprint",
    )
