"""The conservative rule label and the flat patient table.

The label is a computable inference for research review. It is not a formal
clinical diagnosis.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.config import ColumnMap, EvidenceRules, LabelOutput
from cohortweave.functions import text as tx
from cohortweave.functions.times import iso_time
from cohortweave.operators.evidence import MISSING, patient_evidence

# Reason texts, in output order.
REASONS = (
    ("epilepsy_condition", "epilepsy or recurrent seizure care evidence present"),
    ("asm_condition", "two or more distinct ASM schedules attempted"),
    ("seizure_burden_condition", "persistent seizure burden present after escalation to second ASM"),
)
# Texts for an unmet or unobserved condition, in output order.
GAPS = (
    ("epilepsy_condition", "epilepsy_evidence_status", "missing epilepsy evidence"),
    ("asm_condition", "asm_evidence_status", "missing ASM treatment evidence"),
    ("seizure_burden_condition", "seizure_burden_status", "missing seizure burden evidence"),
)
ANCHOR_GAP = "missing second ASM temporal anchor"
NOTE = (
    "Computable inference only, not formal adjudicated ILAE DRE. "
    "Routine data may not fully establish tolerance, appropriateness, "
    "proper use, or sustained seizure freedom."
)


def evaluate_rule(evidence: DataFrame, version: str = "v1") -> DataFrame:
    """Add the three conditions, the label, its reasons and the missing evidence."""

    def texts(items: list[tuple[str, str]]) -> str:
        cases = ", ".join(f"CASE WHEN {condition} THEN '{text}' END" for condition, text in items)
        return f"array_compact(array({cases}))"

    gaps = [(f"{status} = '{MISSING}' OR NOT {condition}", text) for condition, status, text in GAPS]
    gaps.append(("second_asm_start_time IS NULL", ANCHOR_GAP))
    return evidence.selectExpr(
        "*",
        "has_epilepsy_diagnosis OR has_recurrent_seizure_care AS epilepsy_condition",
        "has_two_or_more_distinct_asms AND distinct_asm_count >= 2 AS asm_condition",
        "has_persistent_seizure_burden AND post_second_asm_event_count >= 1 AS seizure_burden_condition",
    ).selectExpr(
        "*",
        "epilepsy_condition AND asm_condition AND seizure_burden_condition AS likely_dre",
        f"'{version}' AS definition_version",
        f"{texts(list(REASONS))} AS reasons",
        f"array_distinct(concat({texts(gaps)}, missing_fields)) AS missing_evidence",
    )


def rule_summary(evaluated: DataFrame) -> DataFrame:
    """Auditable view of the component checks."""
    return evaluated.select(
        "patient_id",
        "definition_version",
        "epilepsy_condition",
        "asm_condition",
        "seizure_burden_condition",
        "likely_dre",
        "missing_evidence",
    )


def rule_results(evaluated: DataFrame) -> DataFrame:
    """The rule result record, with its standing note."""
    return evaluated.select(
        "patient_id",
        "likely_dre",
        "reasons",
        "missing_evidence",
        "evidence_completeness_score",
        "definition_version",
        F.lit(NOTE).alias("notes"),
    )


def flat_rows(evaluated: DataFrame, output: LabelOutput = LabelOutput()) -> DataFrame:
    """The patient table in its fixed column order; lists joined with a pipe."""
    columns = [
        F.col("patient_id"),
        F.col("likely_dre"),
        F.col("definition_version"),
        F.col("evidence_completeness_score"),
        F.col("epilepsy_evidence_status"),
        F.col("asm_evidence_status"),
        F.col("seizure_burden_status"),
        F.col("has_epilepsy_diagnosis"),
        F.col("has_recurrent_seizure_care"),
        F.col("distinct_asm_count"),
        F.col("has_two_or_more_distinct_asms"),
        iso_time(F.col("second_asm_start_time")).alias("second_asm_start_time"),
        F.col("post_second_asm_event_count"),
        F.col("has_persistent_seizure_burden"),
    ]
    if output.include_reasons:
        columns.append(F.array_join("reasons", "|").alias("reasons"))
    if output.include_missing_evidence:
        columns.append(F.array_join("missing_evidence", "|").alias("missing_evidence"))
    if output.include_sources:
        columns.append(F.lit("ehr").alias("modality_sources"))
    return evaluated.select(*columns)


def patient_table(
    diagnoses: DataFrame | None,
    medications: DataFrame | None,
    events: DataFrame | None,
    columns: ColumnMap = ColumnMap(),
    rules: EvidenceRules = EvidenceRules(),
    output: LabelOutput = LabelOutput(),
) -> DataFrame:
    """Whole record path: evidence, rule and flat row. Unsorted; sort at the sink."""
    evidence = patient_evidence(diagnoses, medications, events, columns, rules)
    return flat_rows(evaluate_rule(evidence, output.definition_version), output)


def label_counts(patients: DataFrame) -> DataFrame:
    """Row, positive and negative counts as one row."""
    positive = F.count_if(F.col("likely_dre"))
    return patients.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count(F.lit(1)).alias("patient_count"),
        positive.alias("likely_dre_positive_count"),
        (F.count(F.lit(1)) - positive).alias("likely_dre_negative_count"),
    )


def class_counts(rows: DataFrame, label: str = "likely_dre") -> DataFrame:
    """Counts of class '0' and '1' over text spellings; both classes always appear."""
    counted = rows.agg(
        F.count_if(tx.label_class(F.col(label)) == "0").alias("0"),
        F.count_if(tx.label_class(F.col(label)) == "1").alias("1"),
    )
    return counted.unpivot([], ["0", "1"], "label_class", "row_count")
