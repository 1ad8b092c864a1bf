"""Deterministic linkage of source identifiers to canonical patient identifiers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.config import LinkageConfig
from cohortweave.functions import text as tx
from cohortweave.functions.skew import lookup_join

MATCHED, UNMATCHED, AMBIGUOUS = "matched", "unmatched", "ambiguous"
_STATUS, _KEY, _METHOD, _NOTE = "_match_status", "_source_key", "_match_method", "_match_note"

# Reason notes per row.
NOTE_MISSING = "source identifier was missing"
NOTE_CONFLICT = "source identifier had conflicting explicit mappings"
NOTE_ABSENT = "source identifier was absent from explicit mapping"


def mapping_frame(df: DataFrame, mapping: DataFrame | Mapping[str, str]) -> DataFrame:
    """Mapping as ``(source_id, canonical_patient_id)``."""
    if isinstance(mapping, DataFrame):
        return mapping.selectExpr("source_id", "canonical_patient_id")
    return df.sparkSession.createDataFrame(
        list(mapping.items()), "source_id string, canonical_patient_id string"
    )


def normalized_mapping(mapping: DataFrame, mode: str = "identity") -> DataFrame:
    """One row per normalised key; ``conflicting`` when it maps to several ids."""
    return (
        mapping.select(
            tx.normalize_identifier(F.col("source_id"), mode).alias(_KEY),
            tx.normalize_identifier(F.col("canonical_patient_id")).alias("_canonical"),
        )
        .dropna()
        .groupBy(_KEY)
        .agg(F.expr("max(_canonical) AS _canonical"), F.expr("min(_canonical) <> max(_canonical) AS _conflicting"))
    )


def _check_source(df: DataFrame, config: LinkageConfig) -> None:
    if config.source_id not in df.columns:
        raise ValueError(f"Missing source identifier column: {config.source_id}")


def link_with_mapping(df: DataFrame, config: LinkageConfig, mapping: DataFrame | Mapping[str, str]) -> DataFrame:
    """``df`` with match columns, by an explicit mapping.

    Heavy source ids are spread by the lookup join. Rows without an identifier never
    match, so they carry a spread-out stand-in key instead of meeting in one partition.
    """
    _check_source(df, config)
    keys = normalized_mapping(mapping_frame(df, mapping), config.mode)
    keyed = df.withColumn(_KEY, tx.normalize_identifier(F.col(config.source_id), config.mode))
    plain = [f"`{c}`" for c in df.columns if c != config.output_id or c == config.source_id]
    # A normalised key has no whitespace at its ends, so this stand-in cannot collide.
    spread = f"coalesce({_KEY}, concat(' ', xxhash64({', '.join(f'`{c}`' for c in df.columns)})))"
    facts = keyed.withColumn("_join_key", F.expr(spread))
    return (
        lookup_join(facts, keys.withColumnRenamed(_KEY, "_join_key"), ["_join_key"])
        .selectExpr(
            *plain,
            f"CASE WHEN NOT _conflicting THEN _canonical END AS `{_OUT}`",
            f"coalesce({_KEY}, '') AS {_KEY}",
            f"""CASE WHEN {_KEY} IS NULL THEN '{UNMATCHED}'
                     WHEN _conflicting THEN '{AMBIGUOUS}'
                     WHEN _canonical IS NOT NULL THEN '{MATCHED}'
                     ELSE '{UNMATCHED}' END AS {_STATUS}""",
            f"'explicit_mapping' AS {_METHOD}",
            f"""CASE WHEN {_KEY} IS NULL THEN '{NOTE_MISSING}'
                     WHEN _conflicting THEN '{NOTE_CONFLICT}'
                     WHEN _canonical IS NULL THEN '{NOTE_ABSENT}' END AS {_NOTE}""",
        )
    )


_OUT = "_linked_id"


def link_by_normalization(df: DataFrame, config: LinkageConfig) -> DataFrame:
    """``df`` with match columns, by normalising the identifier only."""
    _check_source(df, config)
    keyed = df.withColumn(_OUT, tx.normalize_identifier(F.col(config.source_id), config.mode))
    plain = [f"`{c}`" for c in df.columns if c != config.output_id or c == config.source_id]
    return keyed.selectExpr(
        *plain,
        f"`{_OUT}`",
        f"coalesce(`{_OUT}`, '') AS {_KEY}",
        f"CASE WHEN `{_OUT}` IS NULL THEN '{UNMATCHED}' ELSE '{MATCHED}' END AS {_STATUS}",
        f"'normalization:{config.mode}' AS {_METHOD}",
        f"CASE WHEN `{_OUT}` IS NULL THEN '{NOTE_MISSING}' END AS {_NOTE}",
    )


def link(df: DataFrame, config: LinkageConfig, mapping: DataFrame | Mapping[str, str] | None = None) -> DataFrame:
    """Explicit mapping when one is given, even an empty one; otherwise normalisation."""
    if mapping is not None:
        return link_with_mapping(df, config, mapping)
    return link_by_normalization(df, config)


def linked_table(linked: DataFrame, config: LinkageConfig) -> DataFrame:
    """The input table with its patient id column last."""
    internal = {_OUT, _KEY, _STATUS, _METHOD, _NOTE, config.output_id}
    if not config.keep_source:
        internal.add(config.source_id)
    kept = [c for c in linked.columns if c not in internal]
    return linked.select(*kept, F.col(_OUT).alias(config.output_id))


def link_records(linked: DataFrame, modality: str) -> DataFrame:
    """One link record per input row."""
    return linked.selectExpr(
        f"'{modality}' AS source_modality",
        f"{_KEY} AS source_id",
        f"{_OUT} AS canonical_patient_id",
        f"{_STATUS} AS match_status",
        f"{_METHOD} AS match_method",
        f"{_NOTE} AS notes",
    )


def link_counts(records: DataFrame, output_id: str = "patient_id", note: str | None = None) -> DataFrame:
    """Counts by status and count notes, one row per modality."""
    counts = records.groupBy("source_modality").agg(
        F.expr("count(1) AS row_count"),
        *[F.expr(f"count_if(match_status = '{s}') AS {s}_count") for s in (MATCHED, UNMATCHED, AMBIGUOUS)],
    )
    notes = [
        F.when(F.col(f"{s}_count") > 0, F.concat_ws(" ", f"{s}_count", "source_modality", F.lit(f"rows were {s}")))
        for s in (UNMATCHED, AMBIGUOUS)
    ]
    return counts.withColumns(
        {
            "output_patient_id_col": F.lit(output_id),
            "notes": F.array_compact(F.array(F.lit(note).cast("string"), *notes)),
        }
    )


def link_summary(counts: Sequence[DataFrame] | DataFrame) -> DataFrame:
    """Per-modality rows plus one total row (``source_modality`` NULL) with the modality count."""
    rows = counts if isinstance(counts, DataFrame) else reduce(DataFrame.unionByName, counts)
    measures = ("row_count", "matched_count", "unmatched_count", "ambiguous_count")
    return rows.rollup("source_modality").agg(
        F.expr("count(1) AS modality_count"), *[F.expr(f"sum({m}) AS {m}") for m in measures]
    )
