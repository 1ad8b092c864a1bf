"""Registered queries for the composite jobs (written to the shared folder, then summarised)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortweave.config import RunContext
from cohortweave.plans import jobs
from cohortweave.plans import catalog_evidence as _first  # noqa: F401  (its SQL is reused)
from cohortweave.plans import views as v
from cohortweave.plans.registry import ORACLES, register
from cohortweave.plans.sql_views import EVIDENCE, with_blocks
from cohortweave.session import fresh_path

RUN = RunContext("run-001", "cohortweave", "jobs", "2025-01-01T00:00:00")


def record_input(spark: SparkSession, d: str) -> jobs.RecordInput:
    return jobs.RecordInput(
        "labels", v.diagnoses(spark, d), v.medications(spark, d), v.seizure_events(spark, d), v.COLUMNS, v.RULES
    )


def image_input(spark: SparkSession, d: str) -> jobs.ImageInput:
    return jobs.ImageInput(
        "volumes", voxels=v.lines(spark, d), headers=v.volume_headers(spark, d), participants=v.participants(spark, d)
    )


def signal_input(spark: SparkSession, d: str) -> jobs.SignalInput:
    return jobs.SignalInput("signals", samples=v.segments(spark, d))


@register("record_job", ORACLES["label_counts"])
def record_job(spark: SparkSession, d: str) -> DataFrame:
    return jobs.record_job(spark, record_input(spark, d), RUN, fresh_path(spark, "record-job")).counts


@register(
    "image_job",
    """SELECT count(DISTINCT label) AS row_count, count(DISTINCT label) AS subject_count, 0::BIGINT AS error_count
       FROM embeddings""",
)
def image_job(spark: SparkSession, d: str) -> DataFrame:
    return jobs.image_job(spark, image_input(spark, d), RUN, fresh_path(spark, "image-job")).counts


@register(
    "signal_job",
    """SELECT count(DISTINCT label) AS row_count, count(DISTINCT label) AS patient_count, 0::BIGINT AS error_count
       FROM embeddings""",
)
def signal_job(spark: SparkSession, d: str) -> DataFrame:
    return jobs.signal_job(spark, signal_input(spark, d), RUN, fresh_path(spark, "signal-job")).counts


@register(
    "multimodal_job",
    with_blocks(
        (*EVIDENCE, "volume_headers"),
        """, sides AS (SELECT patient_id AS id, 1 AS ehr, 0 AS rest FROM ids
                       UNION ALL SELECT subject_id, 0, 1 FROM volume_headers),
             fused AS (SELECT id, max(ehr) AS ehr, max(rest) AS rest FROM sides GROUP BY id)
           SELECT count(*) AS row_count, count(*) AS patient_count,
                  CAST(sum(ehr) AS BIGINT) AS ehr_row_count, CAST(sum(rest) AS BIGINT) AS mri_row_count,
                  CAST(sum(rest) AS BIGINT) AS eeg_row_count, CAST(sum(ehr) AS BIGINT) AS patients_with_ehr,
                  CAST(sum(rest) AS BIGINT) AS patients_with_mri, CAST(sum(rest) AS BIGINT) AS patients_with_eeg,
                  CAST(sum(ehr * rest) AS BIGINT) AS patients_with_all_modalities
           FROM fused""",
    ),
)
def multimodal_job(spark: SparkSession, d: str) -> DataFrame:
    given = jobs.MultimodalInput(
        "everything", record_input(spark, d), image_input(spark, d), signal_input(spark, d)
    )
    result = jobs.multimodal_job(spark, given, RUN, fresh_path(spark, "multimodal-job"))
    return result.counts


# --- patients with records, images and signals ----------------------------------------------------

GROUPS = 20  # patients that the customers and users are gathered into; half of them have a volume and recordings


def _gathered(df: DataFrame) -> DataFrame:
    return df.withColumn("patient_id", F.expr(f"concat('p', cast(patient_id AS bigint) % {GROUPS})"))


def _gathered_sql(select: str) -> str:
    text = with_blocks((*EVIDENCE, "volume_headers", "positions", "voxels"), select)
    for name in ("o_custkey", "user_id"):
        text = text.replace(f"CAST({name} AS VARCHAR) AS patient_id", f"'p' || ({name} % {GROUPS}) AS patient_id")
    return text


@register(
    "multimodal_patients",
    _gathered_sql(
        """SELECT ids.patient_id AS patient_id, ruled.likely_dre AS ehr_likely_dre, ruled.evidence_completeness_score AS completeness,
                  CAST(r.n AS BIGINT) AS eeg_recordings, CAST(x.n AS BIGINT) AS mri_shape_x, true AS has_ehr,
                  r.n IS NOT NULL AS has_mri, r.n IS NOT NULL AS has_eeg
           FROM ids JOIN ruled USING (patient_id)
                LEFT JOIN (SELECT 'p' || label AS patient_id, count(*) AS n FROM embeddings GROUP BY 1) AS r USING (patient_id)
                LEFT JOIN (SELECT subject_id AS patient_id, max(x) + 1 AS n FROM voxels GROUP BY 1) AS x USING (patient_id)"""
    ),
)
def multimodal_patients(spark: SparkSession, d: str) -> DataFrame:
    """The fused table itself, with patients on all three sides; subject numbers are linked to patient numbers."""
    records = jobs.RecordInput(
        "labels", *[_gathered(t(spark, d)) for t in (v.diagnoses, v.medications, v.seizure_events)], v.COLUMNS, v.RULES
    )
    given = jobs.MultimodalInput("everything", records, image_input(spark, d), signal_input(spark, d), train_model=False)
    fused = jobs.multimodal_job(spark, given, RUN, fresh_path(spark, "multimodal-job")).table
    return fused.selectExpr(
        "patient_id",
        "ehr_likely_dre",
        "ehr_evidence_completeness_score AS completeness",
        "eeg_recording_count AS eeg_recordings",
        "cast(mri_shape_x AS bigint) AS mri_shape_x",
        "has_ehr",
        "has_mri",
        "has_eeg",
    )
