"""Per-patient evidence from diagnosis, medication and event tables.

The three tables meet in one partial-aggregated group-by on the patient id. Raw
rows cross the network only for the time comparison against the second-medication
start, where the lookup join spreads heavy patients. Record lists (schedules,
burden events) stay long tables keyed by patient: nothing collects one patient's
rows into one place.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortweave.config import ColumnMap, EvidenceRules
from cohortweave.functions import text as tx
from cohortweave.functions.skew import lookup_join
from cohortweave.functions.times import as_time
from cohortweave.schemas import TIME

OBSERVED, MISSING = "observed", "missing"

DEFAULT_COLUMNS = ColumnMap()
DEFAULT_RULES = EvidenceRules()


def _text(df: DataFrame, name: str | None) -> Column:
    if name and name in df.columns:
        return F.col(name).cast("string")
    return F.lit(None).cast("string")


def _usable(df: DataFrame | None, columns: ColumnMap) -> bool:
    return df is not None and columns.patient_id in df.columns


def _known_patients(df: DataFrame, columns: ColumnMap) -> DataFrame:
    """Rows that belong to some patient."""
    return df.filter(F.col(columns.patient_id).isNotNull())


# --- record-level tables ---------------------------------------------------------------------


def diagnosis_records(
    diagnoses: DataFrame, columns: ColumnMap = DEFAULT_COLUMNS, rules: EvidenceRules = DEFAULT_RULES
) -> DataFrame:
    """Diagnosis rows with both code tests evaluated once and both times parsed."""
    code = _text(diagnoses, columns.diagnosis_code)
    # The key has its own projection, so that it is computed once for all prefixes.
    keyed = _known_patients(diagnoses, columns).select(
        F.col(columns.patient_id).cast("string").alias("patient_id"),
        code.alias("diagnosis_code"),
        tx.code_key(code).alias("_key"),
        as_time(diagnoses, columns.diagnosis_time, columns.time_formats).alias("diagnosis_time"),
        as_time(diagnoses, columns.encounter_time, columns.time_formats).alias("encounter_time"),
    )
    return keyed.select(
        "patient_id",
        "diagnosis_code",
        tx.has_code_prefix(F.col("_key"), rules.epilepsy_prefixes).alias("is_epilepsy"),
        tx.has_code_prefix(F.col("_key"), rules.seizure_prefixes).alias("is_seizure"),
        "diagnosis_time",
        "encounter_time",
    )


def medication_records(
    medications: DataFrame, columns: ColumnMap = DEFAULT_COLUMNS, rules: EvidenceRules = DEFAULT_RULES
) -> DataFrame:
    """Medication rows with their canonical name, NULL where no pattern matches."""
    name = _text(medications, columns.medication_name)
    plain = F.lower(name)
    # Collapsing whitespace can only matter to tokens that contain some.
    if tx.has_whitespace([*rules.medication_patterns, *(t for _, ts in rules.medication_aliases for t in ts)]):
        plain = tx.collapse_whitespace(plain)
    # The plain text has its own projection, so that it is computed once for all tokens.
    texts = _known_patients(medications, columns).select(
        F.col(columns.patient_id).cast("string").alias("patient_id"),
        name.alias("medication_name"),
        plain.alias("_plain"),
        as_time(medications, columns.medication_start, columns.time_formats).alias("start_time"),
        as_time(medications, columns.medication_end, columns.time_formats).alias("end_time"),
        _text(medications, columns.medication_source).alias("source"),
    )
    canonical = tx.canonical_name(F.col("_plain"), rules.medication_patterns, rules.medication_aliases)
    return texts.select(
        "patient_id",
        "medication_name",
        canonical.alias("normalized_medication_name"),
        "start_time",
        "end_time",
        "source",
    )


def event_records(events: DataFrame, columns: ColumnMap = DEFAULT_COLUMNS) -> DataFrame:
    """Event rows with a default type where it is missing or empty."""
    kind = F.coalesce(F.nullif(_text(events, columns.event_type), F.lit("")), F.lit("seizure_event"))
    return _known_patients(events, columns).select(
        F.col(columns.patient_id).cast("string").alias("patient_id"),
        kind.alias("event_type"),
        as_time(events, columns.event_time, columns.time_formats).alias("event_time"),
    )


def medication_schedules(
    medications: DataFrame, columns: ColumnMap = DEFAULT_COLUMNS, rules: EvidenceRules = DEFAULT_RULES
) -> DataFrame:
    """One row per matching medication row.

    The order within a patient is (start, NULL last; normalised name). Sort by
    ``SCHEDULE_ORDER`` to get it; a range sort splits heavy patients as well.
    """
    return (
        medication_records(medications, columns, rules)
        .filter(F.col("normalized_medication_name").isNotNull())
        .select(
            "patient_id",
            "medication_name",
            "normalized_medication_name",
            "start_time",
            "end_time",
            "source",
            F.lit(OBSERVED).alias("status"),
        )
    )


def schedule_order() -> list[Column]:
    return [F.col("patient_id"), F.col("start_time").asc_nulls_last(), F.col("normalized_medication_name")]


# --- second distinct medication --------------------------------------------------------------


def ranked_names(
    medications: DataFrame, columns: ColumnMap = DEFAULT_COLUMNS, rules: EvidenceRules = DEFAULT_RULES
) -> DataFrame:
    """One row per patient and canonical name with its place in the order of first starts.

    Rows without a canonical name share one row that ranks last. The group-by leaves
    at most one row per configured name, so the window never sees a long partition.
    """
    by_name = (
        medication_records(medications, columns, rules)
        .groupBy("patient_id", "normalized_medication_name")
        .agg(F.expr("count(1) AS rows"), F.expr("min(start_time) AS start_time"))
    )
    return by_name.selectExpr(
        "*",
        """row_number() OVER (
             PARTITION BY patient_id
             ORDER BY normalized_medication_name IS NULL, start_time ASC NULLS LAST, normalized_medication_name
           ) AS place""",
    )


def medication_summary(
    medications: DataFrame, columns: ColumnMap = DEFAULT_COLUMNS, rules: EvidenceRules = DEFAULT_RULES
) -> DataFrame:
    """Per patient: row counts, distinct names and the second distinct name's first start."""
    return ranked_names(medications, columns, rules).groupBy("patient_id").agg(
        *[F.expr(f"{_COMBINE[name]}({rule}) AS {name}") for name, rule in _NAME_FACTS.items()]
    )


def second_medication_anchor(
    medications: DataFrame, columns: ColumnMap = DEFAULT_COLUMNS, rules: EvidenceRules = DEFAULT_RULES
) -> DataFrame:
    """Patients with at least two distinct names and the (possibly NULL) anchor time."""
    return ranked_names(medications, columns, rules).filter(_IS_SECOND).selectExpr(
        "patient_id", "normalized_medication_name AS second_medication", "start_time AS second_asm_start_time"
    )


# --- burden events ---------------------------------------------------------------------------


def _fallback_records(diagnosis_rows: DataFrame) -> DataFrame:
    """Seizure-coded diagnoses as events, timed by the first parsable candidate."""
    return diagnosis_rows.filter("is_seizure").select(
        "patient_id",
        F.lit("seizure_coded_diagnosis").alias("event_type"),
        F.coalesce("diagnosis_time", "encounter_time").alias("event_time"),
        F.lit("diagnoses").alias("source"),
        F.concat(F.lit("Seizure-coded diagnosis: "), F.col("diagnosis_code")).alias("description"),
    )


def burden_events(
    diagnoses: DataFrame | None,
    medications: DataFrame | None,
    events: DataFrame | None,
    columns: ColumnMap = DEFAULT_COLUMNS,
    rules: EvidenceRules = DEFAULT_RULES,
) -> DataFrame:
    """Long table of burden events with ``is_post_second_asm``.

    Diagnoses stand in only for patients without a single event row.
    """
    parts = []
    if _usable(events, columns):
        recorded = event_records(events, columns)
        parts.append(
            recorded.select(
                "patient_id",
                "event_type",
                "event_time",
                F.lit("seizure_events").alias("source"),
                F.lit("Seizure burden signal from event table.").alias("description"),
            )
        )
    if _usable(diagnoses, columns) and columns.diagnosis_code in diagnoses.columns:
        fallback = _fallback_records(diagnosis_records(diagnoses, columns, rules))
        if parts:
            covered = recorded.select("patient_id").distinct()
            fallback = lookup_join(fallback, covered, ["patient_id"], "left_anti")
        parts.append(fallback)
    if not parts:
        raise ValueError("burden_events needs an event table or a coded diagnosis table.")
    rows = reduce(DataFrame.unionByName, parts).withColumn("status", F.lit(OBSERVED))
    if not _usable(medications, columns):
        return rows.withColumn("is_post_second_asm", F.lit(False))
    anchors = second_medication_anchor(medications, columns, rules).drop("second_medication")
    after = F.col("event_time") >= F.col("second_asm_start_time")
    return (
        lookup_join(rows, anchors, ["patient_id"])
        .withColumn("is_post_second_asm", F.coalesce(after, F.lit(False)))
        .drop("second_asm_start_time")
    )


# --- one row per patient ---------------------------------------------------------------------

_IS_SECOND = "place = 2 AND normalized_medication_name IS NOT NULL"

# Column of the merged facts -> how rows of one patient combine.
_COMBINE = {
    "dx_rows": "sum",
    "epilepsy_rows": "sum",
    "seizure_rows": "sum",
    "dx_first": "min",
    "dx_last": "max",
    "ev_rows": "sum",
    "ev_first": "min",
    "ev_last": "max",
    "rx_rows": "sum",
    "schedule_count": "sum",
    "distinct_asm_count": "sum",
    "second_asm_start_time": "max",
    "post_ev": "sum",
    "post_dx": "sum",
    "post_ev_first": "min",
    "post_dx_first": "min",
}
# What one row of each kind contributes.
_DIAGNOSIS_FACTS = {
    "dx_rows": "1",
    "epilepsy_rows": "cast(is_epilepsy AS int)",
    "seizure_rows": "cast(is_seizure AS int)",
    "dx_first": "CASE WHEN is_epilepsy OR is_seizure THEN least(diagnosis_time, encounter_time) END",
    "dx_last": "CASE WHEN is_epilepsy OR is_seizure THEN greatest(diagnosis_time, encounter_time) END",
}
_EVENT_FACTS = {"ev_rows": "1", "ev_first": "event_time", "ev_last": "event_time"}
_NAME_FACTS = {
    "rx_rows": "rows",
    "schedule_count": "CASE WHEN normalized_medication_name IS NOT NULL THEN rows END",
    "distinct_asm_count": "cast(normalized_medication_name IS NOT NULL AS int)",
    "second_asm_start_time": f"CASE WHEN {_IS_SECOND} THEN start_time END",
}
_POINT_FACTS = {
    "post_ev": "cast(is_event AS int)",
    "post_dx": "cast(NOT is_event AS int)",
    "post_ev_first": "CASE WHEN is_event THEN time END",
    "post_dx_first": "CASE WHEN NOT is_event THEN time END",
}


def _facts(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Project to the merged layout; facts without a rule are NULL."""
    typed = {name: "bigint" if how == "sum" else TIME.simpleString() for name, how in _COMBINE.items()}
    return df.selectExpr(
        "patient_id", *[f"cast({rules.get(name, 'NULL')} AS {dtype}) AS {name}" for name, dtype in typed.items()]
    )


def patient_facts(
    diagnoses: DataFrame | None,
    medications: DataFrame | None,
    events: DataFrame | None,
    columns: ColumnMap = DEFAULT_COLUMNS,
    rules: EvidenceRules = DEFAULT_RULES,
) -> DataFrame:
    """Counts and first / last times per patient, for every patient of any table."""
    parts: list[DataFrame] = []
    points: list[DataFrame] = []
    if _usable(diagnoses, columns):
        dx = diagnosis_records(diagnoses, columns, rules)
        parts.append(_facts(dx, _DIAGNOSIS_FACTS))
        points.append(
            dx.filter("is_seizure").selectExpr(
                "patient_id", "coalesce(diagnosis_time, encounter_time) AS time", "false AS is_event"
            )
        )
    if _usable(events, columns):
        ev = event_records(events, columns)
        parts.append(_facts(ev, _EVENT_FACTS))
        points.append(ev.selectExpr("patient_id", "event_time AS time", "true AS is_event"))
    if _usable(medications, columns):
        names = ranked_names(medications, columns, rules)
        parts.append(_facts(names, _NAME_FACTS))
        if points:
            # Reading the (never zero) row count keeps both uses of ``names`` the same
            # plan, so its shuffle runs once.
            anchors = names.filter(f"{_IS_SECOND} AND start_time IS NOT NULL AND rows > 0").selectExpr(
                "patient_id", "start_time AS anchor"
            )
            timed = reduce(DataFrame.union, points).filter("time IS NOT NULL")
            after = lookup_join(timed, anchors, ["patient_id"], "inner").filter("time >= anchor")
            parts.append(_facts(after, _POINT_FACTS))
    if not parts:
        raise ValueError("No table with a patient identifier column was provided.")
    merged = []
    for name, how in _COMBINE.items():
        total = f"{how}({name})"
        merged.append(F.expr(f"coalesce({total}, 0) AS {name}" if how == "sum" else f"{total} AS {name}"))
    return reduce(DataFrame.union, parts).groupBy("patient_id").agg(*merged)


def patient_ids(
    diagnoses: DataFrame | None,
    medications: DataFrame | None,
    events: DataFrame | None,
    columns: ColumnMap = DEFAULT_COLUMNS,
) -> DataFrame:
    """Distinct non-null patient ids over the given tables."""
    parts = [
        _known_patients(df, columns).select(F.col(columns.patient_id).cast("string").alias("patient_id"))
        for df in (diagnoses, medications, events)
        if _usable(df, columns)
    ]
    if not parts:
        raise ValueError("No table with a patient identifier column was provided.")
    return reduce(DataFrame.unionByName, parts).distinct()


def matched_codes(
    diagnoses: DataFrame, columns: ColumnMap = DEFAULT_COLUMNS, rules: EvidenceRules = DEFAULT_RULES
) -> DataFrame:
    """Sorted distinct raw spellings of matching codes per patient.

    De-duplicated before collecting, so a list is bounded by the code vocabulary.
    """
    return (
        diagnosis_records(diagnoses, columns, rules)
        .filter("is_epilepsy AND diagnosis_code IS NOT NULL")
        .select("patient_id", "diagnosis_code")
        .distinct()
        .groupBy("patient_id")
        .agg(F.sort_array(F.collect_list("diagnosis_code")).alias("diagnosis_codes"))
    )


def _status(present: str) -> str:
    return f"CASE WHEN {present} THEN '{OBSERVED}' ELSE '{MISSING}' END"


def _listed(**items: str) -> str:
    """Array of the names whose condition holds, in order."""
    return _listed_texts([(condition, name) for name, condition in items.items()])


def _listed_texts(items: list[tuple[str, str]]) -> str:
    cases = ", ".join(f"CASE WHEN {condition} THEN '{text}' END" for condition, text in items)
    return f"array_compact(array({cases}))"


def _notes(*items: tuple[str, str]) -> str:
    """Notes whose condition holds, joined; NULL for none. Conditions may be Python booleans."""
    return f"nullif(array_join({_listed_texts(list(items))}, '; '), '')"


def patient_evidence(
    diagnoses: DataFrame | None,
    medications: DataFrame | None,
    events: DataFrame | None,
    columns: ColumnMap = DEFAULT_COLUMNS,
    rules: EvidenceRules = DEFAULT_RULES,
    facts: DataFrame | None = None,
) -> DataFrame:
    """One flat row per patient with all three evidence domains and completeness."""
    facts = patient_facts(diagnoses, medications, events, columns, rules) if facts is None else facts
    has_codes = diagnoses is not None and columns.diagnosis_code in diagnoses.columns
    no_code_note = "false" if diagnoses is None else ("dx_rows = 0" if has_codes else "true")
    no_names = medications is not None and columns.medication_name not in medications.columns
    no_match_note = "medication name column unavailable" if no_names else "no configured ASM medication patterns found"

    # Diagnoses count as burden events only for patients without event rows.
    burden = facts.selectExpr(
        "*",
        "CASE WHEN ev_rows > 0 THEN 0 ELSE seizure_rows END AS fallback_rows",
        "CASE WHEN ev_rows > 0 THEN ev_rows ELSE seizure_rows END AS burden_rows",
        "CASE WHEN ev_rows > 0 THEN post_ev ELSE post_dx END AS post_count",
        "CASE WHEN ev_rows > 0 THEN post_ev_first ELSE post_dx_first END AS post_first",
    )
    recurrent = f"ev_rows + seizure_rows >= {int(rules.recurrent_threshold)}"
    domains = burden.selectExpr(
        "patient_id",
        _status(f"epilepsy_rows > 0 OR {recurrent}") + " AS epilepsy_evidence_status",
        "epilepsy_rows > 0 AS has_epilepsy_diagnosis",
        f"{recurrent} AS has_recurrent_seizure_care",
        "least(dx_first, ev_first) AS first_evidence_time",
        "greatest(dx_last, ev_last) AS last_evidence_time",
        _listed(diagnoses="epilepsy_rows > 0 OR seizure_rows > 0", seizure_events="ev_rows > 0")
        + " AS epilepsy_sources",
        _notes(
            (no_code_note, "diagnosis code column unavailable"),
            ("dx_rows = 0 AND ev_rows = 0", "no usable epilepsy or seizure care source rows available"),
        )
        + " AS epilepsy_notes",
        _status("schedule_count > 0") + " AS asm_evidence_status",
        "schedule_count",
        "distinct_asm_count",
        "distinct_asm_count >= 2 AS has_two_or_more_distinct_asms",
        "second_asm_start_time",
        _listed(medications="schedule_count > 0") + " AS asm_sources",
        _notes(
            ("rx_rows = 0", "no usable medication source rows available"),
            ("rx_rows > 0 AND schedule_count = 0", no_match_note),
        )
        + " AS asm_notes",
        _status("burden_rows > 0") + " AS seizure_burden_status",
        "burden_rows AS burden_event_count",
        ("post_count >= 1" if rules.require_post_second else "burden_rows >= 1")
        + " AS has_persistent_seizure_burden",
        "post_count AS post_second_asm_event_count",
        "post_first AS first_post_second_asm_event_time",
        _listed(diagnoses="fallback_rows > 0", seizure_events="ev_rows > 0") + " AS burden_sources",
        _notes(
            (
                "second_asm_start_time IS NULL" if rules.require_post_second else "false",
                "second ASM temporal anchor unavailable",
            ),
            ("burden_rows = 0", "no seizure burden event evidence found"),
        )
        + " AS burden_notes",
    )
    # Names of the missing fields, in this order.
    missing_fields = _listed(
        epilepsy_evidence=f"epilepsy_evidence_status = '{MISSING}'",
        asm_treatment_evidence=f"asm_evidence_status = '{MISSING}'",
        seizure_burden_evidence=f"seizure_burden_status = '{MISSING}'",
    )
    return domains.selectExpr("*", f"{missing_fields} AS missing_fields").selectExpr(
        "*", "cast(3 - size(missing_fields) AS double) / 3 AS evidence_completeness_score"
    )


def patient_bundles(
    diagnoses: DataFrame | None,
    medications: DataFrame | None,
    events: DataFrame | None,
    columns: ColumnMap = DEFAULT_COLUMNS,
    rules: EvidenceRules = DEFAULT_RULES,
) -> DataFrame:
    """Nested record per patient: one struct per evidence domain.

    Schedules and burden events are the tables ``medication_schedules`` and
    ``burden_events``, joined to a bundle by ``patient_id`` when needed.
    """
    evidence = patient_evidence(diagnoses, medications, events, columns, rules)
    no_codes = F.array().cast("array<string>")
    if diagnoses is not None and columns.diagnosis_code in diagnoses.columns:
        evidence = evidence.join(matched_codes(diagnoses, columns, rules), "patient_id", "left")
        codes = F.coalesce("diagnosis_codes", no_codes)
    else:
        codes = no_codes

    return evidence.select(
        "*", codes.alias("codes")
    ).selectExpr(
        "patient_id",
        """named_struct('status', epilepsy_evidence_status,
                        'has_epilepsy_diagnosis', has_epilepsy_diagnosis,
                        'has_recurrent_seizure_care', has_recurrent_seizure_care,
                        'diagnosis_codes', codes,
                        'evidence_sources', epilepsy_sources,
                        'first_evidence_time', first_evidence_time,
                        'last_evidence_time', last_evidence_time,
                        'notes', epilepsy_notes) AS epilepsy_evidence""",
        """named_struct('status', asm_evidence_status,
                        'schedule_count', schedule_count,
                        'distinct_asm_count', distinct_asm_count,
                        'has_two_or_more_distinct_asms', has_two_or_more_distinct_asms,
                        'second_asm_start_time', second_asm_start_time,
                        'evidence_sources', asm_sources,
                        'notes', asm_notes) AS asm_treatment_evidence""",
        """named_struct('status', seizure_burden_status,
                        'event_count', burden_event_count,
                        'has_persistent_seizure_burden', has_persistent_seizure_burden,
                        'post_second_asm_event_count', post_second_asm_event_count,
                        'first_post_second_asm_event_time', first_post_second_asm_event_time,
                        'evidence_sources', burden_sources,
                        'notes', burden_notes) AS seizure_burden_evidence""",
        """named_struct('epilepsy_evidence_status', epilepsy_evidence_status,
                        'asm_evidence_status', asm_evidence_status,
                        'seizure_burden_status', seizure_burden_status,
                        'missing_fields', missing_fields,
                        'completeness_score', evidence_completeness_score,
                        'notes', 'Completeness is the proportion of evidence domains that are not missing.')
           AS completeness""",
        "array('ehr') AS modality_sources",
        "'Evidence bundle built from EHR-like source tables.' AS notes",
    )
