"""Full outer fusion of one-row-per-patient tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortweave.config import FusionConfig

FLAGS = ("has_ehr", "has_mri", "has_eeg")


@dataclass(frozen=True)
class Fusion:
    """A fused table with its plan-time notes."""

    table: DataFrame
    notes: list[str]


def namespaced(df: DataFrame, prefix: str, patient_id: str = "patient_id") -> DataFrame:
    """Patient id first, every other column prefixed."""
    rest = [F.col(f"`{c}`").alias(f"{prefix}_{c}") for c in df.columns if c != patient_id]
    return df.select(patient_id, *rest)


def duplicate_count(df: DataFrame, patient_id: str = "patient_id") -> DataFrame:
    """Repeats of a patient id, one row; NULL ids are equal to each other."""
    return (
        df.groupBy(patient_id)
        .agg(F.expr("count(1) AS n"))
        .agg(F.expr("coalesce(sum(n - 1), 0) AS duplicate_count"))
    )


def modality_checks(df: DataFrame, patient_id: str = "patient_id") -> DataFrame:
    """Row count, NULL ids and repeats of one modality table, as one row."""
    ids = df.groupBy(patient_id).agg(F.expr("count(1) AS n"))
    return ids.agg(
        F.expr("coalesce(sum(n), 0) AS row_count"),
        F.expr(f"coalesce(sum(CASE WHEN `{patient_id}` IS NULL THEN n END), 0) AS missing_ids"),
        F.expr("coalesce(sum(n - 1), 0) AS duplicate_count"),
    )


def validate_modality(
    df: DataFrame | None, name: str, config: FusionConfig = FusionConfig()
) -> tuple[bool, list[str]]:
    """Whether the table can take part, and its notes. Repeated ids are an error."""
    if df is None:
        return False, [f"{name} dataframe was not provided"]
    if config.patient_id not in df.columns:
        if df.isEmpty():
            return False, [f"{name} dataframe was empty"]
        message = f"{name} dataframe is missing required column: {config.patient_id}"
        if config.require_patient_id:
            raise ValueError(message)
        return False, [message]
    checks = modality_checks(df, config.patient_id).first()
    if checks.row_count == 0:
        return False, [f"{name} dataframe was empty"]
    if checks.duplicate_count:
        raise ValueError(f"{name} dataframe contains duplicate patient_id values: {checks.duplicate_count}")
    notes = [f"{name} dataframe contains missing patient identifiers"] if checks.missing_ids else []
    return True, notes


def fuse(frames: Mapping[str, DataFrame], config: FusionConfig = FusionConfig()) -> DataFrame:
    """Fuse tables that hold each patient at most once.

    The outer join is a union of the tables, each packed into its own struct,
    grouped by patient id: every table crosses the network once whatever their
    number, and NULL ids meet as in a null-safe join. A repeated id fails the query.
    """
    pid = config.patient_id
    prefixes = dict(config.prefixes)
    present = [name for name in prefixes if name in frames]
    spaced = {name: namespaced(frames[name], prefixes[name], pid) for name in present}
    packed = {
        name: df.select(pid, F.struct(F.lit(True).alias("_present"), *[f"`{c}`" for c in df.columns if c != pid]).alias(name))
        for name, df in spaced.items()
    }
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), packed.values())
    grouped = rows.groupBy(pid).agg(
        *[
            F.expr(
                f"""CASE WHEN count({name}) > 1
                         THEN raise_error('{name} dataframe contains duplicate patient_id values')
                         ELSE first({name}, true) END AS {name}"""
            )
            for name in present
        ]
    )
    flags = []
    if config.include_flags:
        for name in prefixes:
            has = F.col(name).isNotNull() if name in present else F.lit(False)
            flags.append(has.alias(f"has_{name}"))
    columns = [
        F.col(name).getField(c).alias(c) for name in present for c in spaced[name].columns if c != pid
    ]
    return grouped.select(pid, *flags, *columns)


def fused_dataset(
    ehr: DataFrame | None = None,
    mri: DataFrame | None = None,
    eeg: DataFrame | None = None,
    config: FusionConfig = FusionConfig(),
    spark: SparkSession | None = None,
) -> Fusion:
    """Validate the given tables, then fuse those that have rows. Unsorted."""
    notes = [config.note] if config.note else []
    frames: dict[str, DataFrame] = {}
    for name, df in (("ehr", ehr), ("mri", mri), ("eeg", eeg)):
        usable, found = validate_modality(df, name, config)
        notes += found
        if usable:
            frames[name] = df
    if frames:
        return Fusion(fuse(frames, config), list(dict.fromkeys(notes)))
    session = spark or SparkSession.active()
    return Fusion(session.createDataFrame([], f"`{config.patient_id}` string"), list(dict.fromkeys(notes)))


def _flag(fused: DataFrame, flag: str) -> str:
    return f"coalesce({flag}, false)" if flag in fused.columns else "false"


def modality_counts(fused: DataFrame) -> DataFrame:
    """Patients per modality and with all three, as one row."""
    each = {flag: _flag(fused, flag) for flag in FLAGS}
    return fused.agg(
        *[F.expr(f"count_if({test}) AS patients_with_{flag[4:]}") for flag, test in each.items()],
        F.expr(f"count_if({' AND '.join(each.values())}) AS patients_with_all_modalities"),
    )


def fusion_result(fused: DataFrame, patient_id: str = "patient_id") -> DataFrame:
    """Build counts of a fused table: rows, patients and source rows per modality.

    A fused table holds each patient once, so a modality's patients are its rows.
    """
    each = {flag: _flag(fused, flag) for flag in FLAGS}
    return fused.agg(
        F.expr("count(1) AS row_count"),
        F.expr(f"count(DISTINCT `{patient_id}`) AS patient_count"),
        *[F.expr(f"count_if({test}) AS {flag[4:]}_row_count") for flag, test in each.items()],
        *[F.expr(f"count_if({test}) AS patients_with_{flag[4:]}") for flag, test in each.items()],
        F.expr(f"count_if({' AND '.join(each.values())}) AS patients_with_all_modalities"),
    )
