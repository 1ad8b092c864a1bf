"""Feature screening for the baseline model. Everything here is plan-time only."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cohortweave.config import ModelConfig

# Columns that carry the label rule or its parts.
RECORD_DENYLIST = (
    "likely_dre",
    "reasons",
    "missing_evidence",
    "modality_sources",
    "definition_version",
    "epilepsy_evidence_status",
    "asm_evidence_status",
    "seizure_burden_status",
    "has_epilepsy_diagnosis",
    "has_recurrent_seizure_care",
    "distinct_asm_count",
    "has_two_or_more_distinct_asms",
    "second_asm_start_time",
    "post_second_asm_event_count",
    "has_persistent_seizure_burden",
)
# The fused table also drops any column holding one of these terms.
FUSED_TERMS = ("likely_dre", "missing_evidence", "definition_version", "reasons", "reason")
# Nearly determined by the rule; dropped only on request.
STRICT_DENYLIST = ("evidence_completeness_score",)

MODALITY_FLAGS = ("has_ehr", "has_mri", "has_eeg")


@dataclass(frozen=True)
class LeakageReport:
    """Why each looked-at column was kept or dropped."""

    kept: list[str] = field(default_factory=list)
    absent: list[str] = field(default_factory=list)
    identifier: list[str] = field(default_factory=list)
    leakage: list[str] = field(default_factory=list)
    non_numeric: list[str] = field(default_factory=list)
    configured: list[str] = field(default_factory=list)
    notes: list[str] = field(default_factory=list)

    def table(self, df: DataFrame) -> DataFrame:
        """``(column_name, decision)``, one row per looked-at column."""
        rows = [(c, decision) for decision in _DECISIONS for c in getattr(self, decision)]
        return df.sparkSession.createDataFrame(rows, "column_name string, decision string")


_DECISIONS = ("kept", "absent", "identifier", "leakage", "non_numeric", "configured")


def is_numeric_or_bool(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.NumericType, T.BooleanType))


def _leaks(column: str, config: ModelConfig) -> bool:
    if column == config.target:
        return True
    # In the fused table the record columns carry the record prefix.
    prefix = f"{config.record_prefix}_" if config.fused else ""
    if config.strict_leakage and column in (*STRICT_DENYLIST, *(prefix + name for name in STRICT_DENYLIST)):
        return True
    if not config.fused:
        return column in RECORD_DENYLIST
    lowered = column.lower()
    denied = {(prefix + name).lower() for name in RECORD_DENYLIST if name != "modality_sources"}
    return lowered in denied or any(term in lowered for term in FUSED_TERMS)


def screen(df: DataFrame, config: ModelConfig = ModelConfig()) -> LeakageReport:
    """Sort every candidate column into kept or one reason for dropping it."""
    candidates = list(dict.fromkeys(config.features if config.features else df.columns))
    identifiers = {config.patient_id, config.split}
    found: dict[str, list[str]] = {decision: [] for decision in _DECISIONS}
    for column in candidates:
        if column not in df.columns:
            decision = "absent"
        elif column in config.exclude:
            decision = "configured"
        elif column in identifiers:
            decision = "identifier"
        elif _leaks(column, config):
            decision = "leakage"
        elif config.fused and column in MODALITY_FLAGS and not config.include_flags:
            decision = "configured"
        elif not is_numeric_or_bool(df.schema[column].dataType):
            decision = "non_numeric"
        else:
            decision = "kept"
        found[decision].append(column)
    notes = []
    if found["leakage"]:
        kind = "multimodal" if config.fused else "leakage-sensitive"
        notes.append(f"target-derived {kind} columns were excluded")
    if found["non_numeric"]:
        notes.append("non-numeric columns were excluded for this baseline")
    if config.fused and found["configured"]:
        notes.append("configured excluded columns were not used")
    return LeakageReport(**found, notes=notes)


def feature_columns(report: LeakageReport, config: ModelConfig = ModelConfig()) -> list[str]:
    if not report.kept and (config.require_any_feature or not config.fused):
        if config.fused:
            raise ValueError("No safe numeric or boolean feature columns remain.")
        raise ValueError("No safe numeric feature columns remain after leakage checks.")
    return report.kept


def flag_columns(df: DataFrame, features: list[str]) -> list[str]:
    return [f for f in MODALITY_FLAGS if f in df.columns and f in features]
