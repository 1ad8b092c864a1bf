"""Registered queries for evidence and label."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortweave.operators import evidence, label
from cohortweave.plans import views as v
from cohortweave.plans.registry import presented, register
from cohortweave.plans.sql_views import EVIDENCE, iso, r6, with_blocks

def records(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return v.diagnoses(spark, d), v.medications(spark, d), v.seizure_events(spark, d)


def _evidence(spark: SparkSession, d: str) -> DataFrame:
    return evidence.patient_evidence(*records(spark, d), v.COLUMNS, v.RULES)


def _ruled(spark: SparkSession, d: str) -> DataFrame:
    return label.evaluate_rule(_evidence(spark, d))


# --- evidence and label ----------------------------------------------------------------------


@register(
    "patient_labels",
    with_blocks(
        EVIDENCE,
        f"""SELECT patient_id, likely_dre, 'v1' AS definition_version,
                   {r6('evidence_completeness_score')} AS evidence_completeness_score,
                   epilepsy_evidence_status, asm_evidence_status, seizure_burden_status, has_epilepsy_diagnosis,
                   has_recurrent_seizure_care, distinct_asm_count,
                   distinct_asm_count >= 2 AS has_two_or_more_distinct_asms,
                   strftime(anchor, '%Y-%m-%dT%H:%M:%S') AS second_asm_start_time,
                   post_count AS post_second_asm_event_count,
                   post_count >= 1 AS has_persistent_seizure_burden, reasons, missing_evidence,
                   'ehr' AS modality_sources FROM ruled""",
    ),
)
def patient_labels(spark: SparkSession, d: str) -> DataFrame:
    return presented(label.patient_table(*records(spark, d), v.COLUMNS, v.RULES))


@register(
    "label_counts",
    with_blocks(
        EVIDENCE,
        """SELECT count(*) AS row_count, count(*) AS patient_count,
                  count(*) FILTER (likely_dre) AS likely_dre_positive_count,
                  count(*) FILTER (NOT likely_dre) AS likely_dre_negative_count FROM ruled""",
    ),
)
def label_counts(spark: SparkSession, d: str) -> DataFrame:
    return label.label_counts(_ruled(spark, d))


@register(
    "rule_summary",
    with_blocks(
        EVIDENCE,
        """SELECT patient_id, 'v1' AS definition_version, epilepsy_condition, asm_condition,
                  seizure_burden_condition, likely_dre, missing_evidence FROM ruled""",
    ),
)
def rule_summary(spark: SparkSession, d: str) -> DataFrame:
    return presented(label.rule_summary(_ruled(spark, d)))


@register(
    "rule_results",
    with_blocks(
        EVIDENCE,
        f"""SELECT patient_id, likely_dre, reasons, missing_evidence,
                   {r6('evidence_completeness_score')} AS evidence_completeness_score,
                   'v1' AS definition_version, '{label.NOTE}' AS notes FROM ruled""",
    ),
)
def rule_results(spark: SparkSession, d: str) -> DataFrame:
    return presented(label.rule_results(_ruled(spark, d)))


@register(
    "missing_evidence",
    with_blocks(
        EVIDENCE,
        """SELECT item, count(*) AS patients
           FROM (SELECT unnest(string_split(missing_evidence, '|')) AS item FROM ruled WHERE missing_evidence <> '')
           GROUP BY item""",
    ),
)
def missing_evidence(spark: SparkSession, d: str) -> DataFrame:
    items = _ruled(spark, d).selectExpr("explode(missing_evidence) AS item")
    return items.groupBy("item").agg(F.expr("count(1) AS patients"))


@register("patient_ids", with_blocks(("diagnoses", "medications", "seizure_events", "ids"), "SELECT patient_id FROM ids"))
def patient_ids(spark: SparkSession, d: str) -> DataFrame:
    return evidence.patient_ids(*records(spark, d), v.COLUMNS)


@register(
    "epilepsy_evidence",
    with_blocks(
        EVIDENCE,
        f"""SELECT patient_id, epilepsy_evidence_status AS status, has_epilepsy_diagnosis,
                   has_recurrent_seizure_care, codes AS diagnosis_codes,
                   concat_ws('|', CASE WHEN matched_dx THEN 'diagnoses' END,
                             CASE WHEN ev_rows > 0 THEN 'seizure_events' END) AS evidence_sources,
                   {iso('first_evidence_time')} AS first_evidence_time,
                   {iso('last_evidence_time')} AS last_evidence_time,
                   nullif(concat_ws('; ', CASE WHEN dx_rows = 0 THEN 'diagnosis code column unavailable' END,
                          CASE WHEN dx_rows = 0 AND ev_rows = 0
                               THEN 'no usable epilepsy or seizure care source rows available' END), '') AS notes
            FROM ruled""",
    ),
)
def epilepsy_evidence(spark: SparkSession, d: str) -> DataFrame:
    bundles = evidence.patient_bundles(*records(spark, d), v.COLUMNS, v.RULES)
    return presented(bundles.select("patient_id", "epilepsy_evidence.*"))


@register(
    "treatment_evidence",
    with_blocks(
        EVIDENCE,
        f"""SELECT patient_id, asm_evidence_status AS status, schedule_count, distinct_asm_count,
                   distinct_asm_count >= 2 AS has_two_or_more_distinct_asms,
                   {iso('anchor')} AS second_asm_start_time,
                   CASE WHEN schedule_count > 0 THEN 'medications' ELSE '' END AS evidence_sources,
                   CASE WHEN rx_rows = 0 THEN 'no usable medication source rows available'
                        WHEN schedule_count = 0 THEN 'no configured ASM medication patterns found' END AS notes
            FROM ruled""",
    ),
)
def treatment_evidence(spark: SparkSession, d: str) -> DataFrame:
    bundles = evidence.patient_bundles(*records(spark, d), v.COLUMNS, v.RULES)
    return presented(bundles.select("patient_id", "asm_treatment_evidence.*"))


@register(
    "burden_evidence",
    with_blocks(
        EVIDENCE,
        f"""SELECT patient_id, seizure_burden_status AS status, event_rows AS event_count,
                   post_count >= 1 AS has_persistent_seizure_burden,
                   post_count AS post_second_asm_event_count,
                   {iso('post_first')} AS first_post_second_asm_event_time,
                   coalesce(burden_source, '') AS evidence_sources,
                   nullif(concat_ws('; ', CASE WHEN anchor IS NULL THEN 'second ASM temporal anchor unavailable' END,
                          CASE WHEN event_rows = 0 THEN 'no seizure burden event evidence found' END), '') AS notes
            FROM ruled""",
    ),
)
def burden_evidence(spark: SparkSession, d: str) -> DataFrame:
    bundles = evidence.patient_bundles(*records(spark, d), v.COLUMNS, v.RULES)
    return presented(bundles.select("patient_id", "seizure_burden_evidence.*"))


@register(
    "completeness",
    with_blocks(
        EVIDENCE,
        f"""SELECT patient_id, epilepsy_evidence_status, asm_evidence_status, seizure_burden_status, missing_fields,
                   {r6('evidence_completeness_score')} AS completeness_score,
                   'Completeness is the proportion of evidence domains that are not missing.' AS notes
            FROM ruled""",
    ),
)
def completeness(spark: SparkSession, d: str) -> DataFrame:
    bundles = evidence.patient_bundles(*records(spark, d), v.COLUMNS, v.RULES)
    return presented(bundles.select("patient_id", "completeness.*"))


@register(
    "medication_schedules",
    with_blocks(
        ("medications", "rx"),
        f"""SELECT patient_id, medication_name, name AS normalized_medication_name,
                   {iso('medication_start')} AS start_time, {iso('medication_end')} AS end_time, source,
                   'observed' AS status FROM rx WHERE name IS NOT NULL""",
    ),
)
def medication_schedules(spark: SparkSession, d: str) -> DataFrame:
    return presented(evidence.medication_schedules(v.medications(spark, d), v.COLUMNS, v.RULES))


@register(
    "second_anchor",
    with_blocks(
        ("medications", "rx", "names", "anchors"),
        f"SELECT patient_id, second_medication, {iso('anchor')} AS second_asm_start_time FROM anchors",
    ),
)
def second_anchor(spark: SparkSession, d: str) -> DataFrame:
    return presented(evidence.second_medication_anchor(v.medications(spark, d), v.COLUMNS, v.RULES))


@register(
    "medication_summary",
    with_blocks(
        ("medications", "rx", "names", "anchors", "rx_agg"),
        f"""SELECT patient_id, rx_rows, schedule_count, distinct_asm_count, {iso('anchor')} AS second_asm_start_time
            FROM rx_agg LEFT JOIN anchors USING (patient_id)""",
    ),
)
def medication_summary(spark: SparkSession, d: str) -> DataFrame:
    summary = evidence.medication_summary(v.medications(spark, d), v.COLUMNS, v.RULES)
    return presented(summary.fillna(0, ["schedule_count", "distinct_asm_count"]))


@register(
    "burden_events",
    with_blocks(
        ("diagnoses", "medications", "seizure_events", "dx", "rx", "ev", "names", "anchors", "events_used"),
        f"""SELECT patient_id, event_type, {iso('event_time')} AS event_time, source, description,
                   'observed' AS status, coalesce(event_time >= anchor, false) AS is_post_second_asm
            FROM events_used LEFT JOIN anchors USING (patient_id)""",
    ),
)
def burden_events(spark: SparkSession, d: str) -> DataFrame:
    return presented(evidence.burden_events(*records(spark, d), v.COLUMNS, v.RULES))


@register(
    "label_synonyms",
    """SELECT label_class, count(n) AS row_count
       FROM (VALUES ('0'), ('1')) AS c(label_class)
            LEFT JOIN (SELECT 1 AS n, CASE WHEN o_totalprice > 250000 THEN '1' ELSE '0' END AS label_class
                       FROM orders) USING (label_class)
       GROUP BY label_class""",
)
def label_synonyms(spark: SparkSession, d: str) -> DataFrame:
    spelled = v.table(spark, d, "orders").selectExpr(
        """CASE WHEN o_totalprice > 250000 AND o_orderstatus = 'F' THEN ' TRUE'
                WHEN o_totalprice > 250000 AND o_orderstatus = 'O' THEN 'Yes'
                WHEN o_totalprice > 250000 THEN '1'
                WHEN o_orderstatus = 'F' THEN 'False '
                WHEN o_orderstatus = 'O' THEN 'n' ELSE '0' END AS likely_dre"""
    )
    return label.class_counts(spelled)
