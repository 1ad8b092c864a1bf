"""Immutable settings accepted by the operators."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class ColumnMap:
    """Physical column names behind the logical roles of the record tables.

    ``None`` means the role is absent; a name that a table does not carry is
    treated the same way, so every optional column degrades to NULL.
    """

    patient_id: str = "patient_id"
    diagnosis_code: str = "diagnosis_code"
    diagnosis_time: str | None = "diagnosis_time"
    encounter_time: str | None = "encounter_time"
    medication_name: str = "medication_name"
    medication_start: str | None = "medication_start"
    medication_end: str | None = "medication_end"
    medication_source: str | None = "source"
    event_time: str | None = "event_time"
    event_type: str | None = "event_type"
    time_formats: tuple[str, ...] = ()


# The label rule is defined on exactly these codes and names.
EPILEPSY_PREFIXES = ("G40", "R56", "345", "780")
SEIZURE_PREFIXES = ("R56", "780", "345", "G40")
MEDICATION_PATTERNS = (
    "levetiracetam",
    "keppra",
    "valpro",
    "divalproex",
    "lamotrigine",
    "carbamazepine",
    "oxcarbazepine",
    "phenytoin",
    "topiramate",
    "zonisamide",
    "lacosamide",
    "clobazam",
    "clonazepam",
    "phenobarbital",
)
MEDICATION_ALIASES = (
    ("levetiracetam", ("keppra", "levetiracetam")),
    ("valproate", ("divalproex", "valpro")),
)


@dataclass(frozen=True)
class EvidenceRules:
    """Code prefixes, medication patterns and thresholds of the label rule.

    ``medication_aliases`` lists ``(canonical name, tokens)``; aliases win over
    patterns, and patterns win in their listed order.
    """

    epilepsy_prefixes: tuple[str, ...] = EPILEPSY_PREFIXES
    seizure_prefixes: tuple[str, ...] = SEIZURE_PREFIXES
    medication_patterns: tuple[str, ...] = MEDICATION_PATTERNS
    medication_aliases: tuple[tuple[str, tuple[str, ...]], ...] = MEDICATION_ALIASES
    recurrent_threshold: int = 2
    require_post_second: bool = True


@dataclass(frozen=True)
class LabelOutput:
    """Which optional columns the flat label table carries."""

    include_reasons: bool = True
    include_missing_evidence: bool = True
    include_sources: bool = True
    definition_version: str = "v1"


@dataclass(frozen=True)
class LinkageConfig:
    source_id: str
    output_id: str = "patient_id"
    mode: str = "identity"
    keep_source: bool = True
    note: str | None = None


@dataclass(frozen=True)
class VolumeConfig:
    foreground_percentile: float = 20.0
    min_foreground_voxels: int = 5000
    levels: int = 64
    max_slices: int | None = 3  # None: every slice with foreground


# Band edges in Hz, lower edge inclusive, upper edge exclusive.
BANDS = (
    ("delta", 0.5, 4.0),
    ("theta", 4.0, 8.0),
    ("alpha", 8.0, 13.0),
    ("beta", 13.0, 30.0),
    ("gamma", 30.0, 80.0),
)


@dataclass(frozen=True)
class SignalConfig:
    channel_limit: int | None = None
    max_seconds: float | None = None  # a limit drops later samples, so it is an explicit choice
    task_samples: int = 1 << 22  # longer channels are transformed by several tasks
    amplitude: bool = True
    quality: bool = True
    frequency: bool = True


@dataclass(frozen=True)
class FusionConfig:
    patient_id: str = "patient_id"
    prefixes: tuple[tuple[str, str], ...] = (("ehr", "ehr"), ("mri", "mri"), ("eeg", "eeg"))
    include_flags: bool = True
    require_patient_id: bool = True
    note: str | None = None


@dataclass(frozen=True)
class ModelConfig:
    target: str = "likely_dre"
    patient_id: str = "patient_id"
    split: str | None = None
    features: tuple[str, ...] | None = None
    exclude: tuple[str, ...] = ()
    test_size: float = 0.2
    val_size: float = 0.1
    seed: int = 42
    stratify: bool = True
    model_type: str = "logistic_regression"
    balanced: bool = True
    max_iter: int = 1000
    # Settings that only matter for a fused table.
    fused: bool = False
    record_prefix: str = "ehr"  # the fusion prefix of the record table
    include_flags: bool = True
    allow_single_modality: bool = True
    require_any_feature: bool = True
    strict_leakage: bool = False
    note: str | None = None


def fused_model_config(**overrides) -> ModelConfig:
    """Defaults for training on the fused multimodal table."""
    return ModelConfig(**{"target": "ehr_likely_dre", "fused": True, **overrides})


@dataclass(frozen=True)
class RunContext:
    run_id: str
    project_name: str
    stage_name: str
    timestamp_utc: str
    seed: int | None = None
    metadata: dict[str, str] = field(default_factory=dict)
