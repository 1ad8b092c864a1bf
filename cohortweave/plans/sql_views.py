"""SQL building blocks for the side-by-side check of the registered queries."""

from __future__ import annotations

from cohortweave.plans.views import CTES

_RX_PATTERNS = (
    ("azurol", "brand#3 blue"),
    ("azurol", "brand#5 hot"),
    ("brand#7 cold", "brand#7 cold"),
    ("brand#9 red", "brand#9 red"),
    ("brand#11 new", "brand#11 new"),
    ("brand#13 old", "brand#13 old"),
    ("brand#15 small", "brand#15 small"),
    ("brand#17 large", "brand#17 large"),
)
_RX_CASE = " ".join(f"WHEN contains(plain, '{token}') THEN '{name}'" for name, token in _RX_PATTERNS)

BLOCKS = {
    **CTES,
    "dx": """
        SELECT *, starts_with(k, '1F0') OR starts_with(k, '2P01') AS is_epilepsy,
               starts_with(k, '2P0') OR starts_with(k, '1F01') AS is_seizure
        FROM (SELECT *, replace(upper(trim(diagnosis_code)), '.', '') AS k FROM diagnoses)""",
    "rx": f"""
        SELECT *, CASE {_RX_CASE} END AS name
        FROM (SELECT *, regexp_replace(lower(trim(medication_name)), '\\s+', ' ', 'g') AS plain FROM medications)""",
    "ev": """
        SELECT patient_id, event_time, coalesce(nullif(event_type, ''), 'seizure_event') AS event_type
        FROM seizure_events""",
    "names": """
        SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY start_time NULLS LAST, name) AS place
        FROM (SELECT patient_id, name, min(medication_start) AS start_time FROM rx
              WHERE name IS NOT NULL GROUP BY ALL)""",
    "anchors": "SELECT patient_id, name AS second_medication, start_time AS anchor FROM names WHERE place = 2",
    "ids": """
        SELECT patient_id FROM diagnoses UNION SELECT patient_id FROM medications
        UNION SELECT patient_id FROM seizure_events""",
    "dx_agg": """
        SELECT patient_id, count(*) AS dx_rows,
               count(*) FILTER (is_epilepsy) AS epilepsy_rows, count(*) FILTER (is_seizure) AS seizure_rows,
               min(least(diagnosis_time, encounter_time)) FILTER (is_epilepsy OR is_seizure) AS dx_first,
               max(greatest(diagnosis_time, encounter_time)) FILTER (is_epilepsy OR is_seizure) AS dx_last,
               string_agg(DISTINCT diagnosis_code, '|' ORDER BY diagnosis_code) FILTER (is_epilepsy) AS codes
        FROM dx GROUP BY patient_id""",
    "rx_agg": """
        SELECT patient_id, count(*) AS rx_rows, count(name) AS schedule_count,
               count(DISTINCT name) AS distinct_asm_count
        FROM rx GROUP BY patient_id""",
    "ev_agg": """
        SELECT patient_id, count(*) AS ev_rows, min(event_time) AS ev_first, max(event_time) AS ev_last
        FROM ev GROUP BY patient_id""",
    "events_used": """
        SELECT patient_id, event_type, event_time, 'seizure_events' AS source,
               'Seizure burden signal from event table.' AS description FROM ev
        UNION ALL
        SELECT patient_id, 'seizure_coded_diagnosis', coalesce(diagnosis_time, encounter_time), 'diagnoses',
               'Seizure-coded diagnosis: ' || diagnosis_code
        FROM dx WHERE is_seizure AND patient_id NOT IN (SELECT patient_id FROM ev)""",
    "burden": """
        SELECT patient_id, count(*) AS event_rows, max(source) AS source,
               count(*) FILTER (event_time >= anchor) AS post_count,
               min(event_time) FILTER (event_time >= anchor) AS post_first
        FROM events_used LEFT JOIN anchors USING (patient_id) GROUP BY patient_id""",
    "evidence": """
        SELECT patient_id,
               coalesce(dx_rows, 0) AS dx_rows, coalesce(ev_rows, 0) AS ev_rows, coalesce(rx_rows, 0) AS rx_rows,
               coalesce(epilepsy_rows, 0) > 0 AS has_epilepsy_diagnosis,
               coalesce(ev_rows, 0) + coalesce(seizure_rows, 0) >= 2 AS has_recurrent_seizure_care,
               coalesce(epilepsy_rows, 0) + coalesce(seizure_rows, 0) > 0 AS matched_dx,
               least(dx_first, ev_first) AS first_evidence_time,
               greatest(dx_last, ev_last) AS last_evidence_time, coalesce(codes, '') AS codes,
               coalesce(schedule_count, 0) AS schedule_count,
               coalesce(distinct_asm_count, 0) AS distinct_asm_count, anchor,
               coalesce(event_rows, 0) AS event_rows, coalesce(post_count, 0) AS post_count, post_first,
               burden.source AS burden_source
        FROM ids LEFT JOIN dx_agg USING (patient_id) LEFT JOIN rx_agg USING (patient_id)
             LEFT JOIN ev_agg USING (patient_id) LEFT JOIN anchors USING (patient_id)
             LEFT JOIN burden USING (patient_id)""",
    "ruled": """
        SELECT *, epilepsy_condition AND asm_condition AND seizure_burden_condition AS likely_dre,
               CASE WHEN epilepsy_condition THEN 'observed' ELSE 'missing' END AS epilepsy_evidence_status,
               CASE WHEN schedule_count > 0 THEN 'observed' ELSE 'missing' END AS asm_evidence_status,
               CASE WHEN event_rows > 0 THEN 'observed' ELSE 'missing' END AS seizure_burden_status,
               (epilepsy_condition::INT + (schedule_count > 0)::INT + (event_rows > 0)::INT)::DOUBLE / 3
                   AS evidence_completeness_score,
               concat_ws('|', CASE WHEN NOT epilepsy_condition THEN 'epilepsy_evidence' END,
                         CASE WHEN schedule_count = 0 THEN 'asm_treatment_evidence' END,
                         CASE WHEN event_rows = 0 THEN 'seizure_burden_evidence' END) AS missing_fields,
               concat_ws('|',
                 CASE WHEN epilepsy_condition THEN 'epilepsy or recurrent seizure care evidence present' END,
                 CASE WHEN asm_condition THEN 'two or more distinct ASM schedules attempted' END,
                 CASE WHEN seizure_burden_condition
                      THEN 'persistent seizure burden present after escalation to second ASM' END) AS reasons,
               concat_ws('|',
                 CASE WHEN NOT epilepsy_condition THEN 'missing epilepsy evidence' END,
                 CASE WHEN NOT asm_condition THEN 'missing ASM treatment evidence' END,
                 CASE WHEN NOT seizure_burden_condition THEN 'missing seizure burden evidence' END,
                 CASE WHEN anchor IS NULL THEN 'missing second ASM temporal anchor' END,
                 CASE WHEN NOT epilepsy_condition THEN 'epilepsy_evidence' END,
                 CASE WHEN schedule_count = 0 THEN 'asm_treatment_evidence' END,
                 CASE WHEN event_rows = 0 THEN 'seizure_burden_evidence' END) AS missing_evidence
        FROM (SELECT *, has_epilepsy_diagnosis OR has_recurrent_seizure_care AS epilepsy_condition,
                     distinct_asm_count >= 2 AS asm_condition,
                     post_count >= 1 AS seizure_burden_condition FROM evidence)""",
}
EVIDENCE = (
    "diagnoses", "medications", "seizure_events", "dx", "rx", "ev", "names", "anchors", "ids", "dx_agg", "rx_agg",
    "ev_agg", "events_used", "burden", "evidence", "ruled",
)


def with_blocks(names: tuple[str, ...], select: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({BLOCKS[n]})" for n in names) + "\n" + select


def r6(expression: str) -> str:
    """Six digits, without a negative zero."""
    return f"round({expression}, 6) + 0.0"


def iso(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S.%f')"
