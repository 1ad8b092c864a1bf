"""Evidence and rule label on small literal tables."""

from datetime import datetime

import pytest

from cohortweave import schemas
from cohortweave.config import ColumnMap, EvidenceRules, LabelOutput
from cohortweave.functions import text as tx
from cohortweave.operators import evidence, label


def diagnoses(spark, *rows):
    return spark.createDataFrame(list(rows), "patient_id string, diagnosis_code string, diagnosis_time string")


def medications(spark, *rows):
    return spark.createDataFrame(list(rows), "patient_id string, medication_name string, medication_start string")


def events(spark, *rows):
    return spark.createDataFrame(list(rows), "patient_id string, event_time string, event_type string")


def by_patient(df):
    return {r.patient_id: r for r in df.collect()}


@pytest.fixture(scope="module")
def cohort(spark):
    dx = diagnoses(
        spark,
        ("pos", "G40.909", "2025-01-01"),
        ("neg", "I10", "2025-01-01"),
        ("fallback", " r56.9\t", "2025-05-01"),
        ("fallback", "345.1", "2025-01-01"),
        ("edge", "G40", None),
        (None, "G40", "2025-01-01"),
    )
    rx = medications(
        spark,
        ("pos", "Keppra 500 mg", "2025-01-01"),
        ("pos", "levetiracetam", "2025-01-10"),
        ("pos", "Lamotrigine", "2025-02-01"),
        ("neg", "aspirin", "2025-01-01"),
        ("fallback", "Divalproex ER", "2025-01-01"),
        ("fallback", "clobazam", "2025-03-01"),
        ("edge", "topiramate", "2025-01-01"),
        ("edge", "phenytoin", "2025-02-01"),
        ("nostart", "topiramate", "2025-01-01"),
        ("nostart", "phenytoin", None),
        ("single", "Valproic acid", "2025-01-01"),
    )
    ev = events(
        spark,
        ("pos", "2025-03-01", "tonic"),
        ("pos", "2025-01-15", "tonic"),
        ("edge", "2025-02-01", ""),
        ("nostart", "2025-06-01", "x"),
        ("nostart", "not a time", "x"),
    )
    return dx, rx, ev


def test_label_rows(cohort):
    rows = by_patient(label.patient_table(*cohort))
    assert set(rows) == {"pos", "neg", "fallback", "edge", "nostart", "single"}
    pos = rows["pos"]
    assert pos.likely_dre is True and pos.distinct_asm_count == 2
    assert pos.second_asm_start_time == "2025-02-01T00:00:00"
    assert pos.post_second_asm_event_count == 1 and pos.missing_evidence == ""
    assert pos.reasons == "|".join(text for _, text in label.REASONS)
    assert pos.modality_sources == "ehr" and pos.definition_version == "v1"
    neg = rows["neg"]
    assert neg.likely_dre is False and neg.evidence_completeness_score == 0.0
    assert neg.missing_evidence == (
        "missing epilepsy evidence|missing ASM treatment evidence|missing seizure burden evidence|"
        "missing second ASM temporal anchor|epilepsy_evidence|asm_treatment_evidence|seizure_burden_evidence"
    )


def test_event_on_the_anchor_counts(cohort):
    edge = by_patient(label.patient_table(*cohort))["edge"]
    assert edge.post_second_asm_event_count == 1 and edge.likely_dre is True


def test_fallback_uses_seizure_coded_diagnoses(cohort):
    row = by_patient(label.patient_table(*cohort))["fallback"]
    assert row.likely_dre is True and row.post_second_asm_event_count == 1
    long = [r for r in evidence.burden_events(*cohort).collect() if r.patient_id == "fallback"]
    assert {r.event_type for r in long} == {"seizure_coded_diagnosis"}
    assert sorted(r.is_post_second_asm for r in long) == [False, True]
    assert {r.description for r in long} == {"Seizure-coded diagnosis:  r56.9\t", "Seizure-coded diagnosis: 345.1"}


def test_null_start_of_second_medication_gives_no_anchor(cohort):
    row = by_patient(label.patient_table(*cohort))["nostart"]
    assert row.has_two_or_more_distinct_asms and row.second_asm_start_time is None
    assert row.likely_dre is False and "missing second ASM temporal anchor" in row.missing_evidence
    assert row.has_recurrent_seizure_care is True


def test_without_post_second_requirement(cohort):
    rules = EvidenceRules(require_post_second=False)
    row = by_patient(label.patient_table(*cohort, rules=rules))["nostart"]
    assert row.has_persistent_seizure_burden is True and row.likely_dre is False


def test_bundles(cohort):
    rows = by_patient(evidence.patient_bundles(*cohort))
    pos = rows["pos"]
    assert pos.epilepsy_evidence.diagnosis_codes == ["G40.909"]
    assert pos.epilepsy_evidence.evidence_sources == ["diagnoses", "seizure_events"]
    assert pos.epilepsy_evidence.first_evidence_time == datetime(2025, 1, 1)
    assert pos.epilepsy_evidence.last_evidence_time == datetime(2025, 3, 1)
    assert pos.seizure_burden_evidence.first_post_second_asm_event_time == datetime(2025, 3, 1)
    assert rows["fallback"].epilepsy_evidence.diagnosis_codes == [" r56.9\t", "345.1"]
    assert rows["neg"].asm_treatment_evidence.notes == "no configured ASM medication patterns found"
    assert rows["single"].epilepsy_evidence.notes == (
        "diagnosis code column unavailable; no usable epilepsy or seizure care source rows available"
    )
    assert rows["neg"].seizure_burden_evidence.notes == (
        "second ASM temporal anchor unavailable; no seizure burden event evidence found"
    )
    assert rows["neg"].completeness.completeness_score == 0.0


def test_schedule_order(cohort):
    ordered = evidence.medication_schedules(cohort[1]).orderBy(*evidence.schedule_order()).collect()
    names = [r.normalized_medication_name for r in ordered if r.patient_id == "nostart"]
    assert names == ["topiramate", "phenytoin"]


def test_second_name_ties_break_by_name(spark):
    rx = medications(spark, ("p", "zonisamide", "2025-01-01"), ("p", "clobazam", "2025-01-01"))
    row = evidence.second_medication_anchor(rx).first()
    assert row.second_medication == "zonisamide"


def test_absent_tables_and_columns(spark):
    only_codes = spark.createDataFrame([("p1", "R56"), ("p1", "780.39")], "patient_id string, diagnosis_code string")
    row = label.patient_table(only_codes, None, None).first()
    assert row.has_epilepsy_diagnosis and row.has_recurrent_seizure_care and not row.likely_dre
    ids_only = spark.createDataFrame([("b",), ("a",)], "patient_id string")
    rows = by_patient(label.patient_table(ids_only, ids_only, None))
    assert set(rows) == {"a", "b"} and not rows["a"].likely_dre
    notes = by_patient(evidence.patient_bundles(ids_only, ids_only, None))["a"]
    assert notes.epilepsy_evidence.notes == "diagnosis code column unavailable"
    assert notes.asm_treatment_evidence.notes == "medication name column unavailable"


def test_renamed_columns(spark):
    dx = spark.createDataFrame([(7, "g40.1")], "pid bigint, code string")
    columns = ColumnMap(patient_id="pid", diagnosis_code="code")
    assert label.patient_table(dx, None, None, columns).first().patient_id == "7"


def test_empty_input_keeps_the_schema(spark):
    empty = label.patient_table(
        schemas.empty(spark, schemas.DIAGNOSES),
        schemas.empty(spark, schemas.MEDICATIONS),
        schemas.empty(spark, schemas.SEIZURE_EVENTS),
    )
    assert empty.count() == 0
    assert empty.columns[:2] == ["patient_id", "likely_dre"] and len(empty.columns) == 17
    bare = LabelOutput(include_reasons=False, include_missing_evidence=False, include_sources=False)
    assert len(label.patient_table(schemas.empty(spark, schemas.DIAGNOSES), None, None, output=bare).columns) == 14
    counts = label.label_counts(empty).first()
    assert counts.row_count == 0 and counts.likely_dre_negative_count == 0


def test_patient_ids_union(cohort):
    ids = {r.patient_id for r in evidence.patient_ids(*cohort).collect()}
    assert ids == {"pos", "neg", "fallback", "edge", "nostart", "single"}


def test_iso_time_with_fraction(spark):
    rx = medications(spark, ("p", "clobazam", "2025-01-01"), ("p", "phenytoin", "2025-01-02 03:04:05.6"))
    row = label.patient_table(None, rx, None).first()
    assert row.second_asm_start_time == "2025-01-02T03:04:05.600000"


def test_medication_names(spark):
    df = spark.createDataFrame(
        [("  KEPPRA XR ",), ("depakote divalproex",), ("oxcarbazepine",), ("aspirin",), (None,)], "n string"
    )
    rules = EvidenceRules()
    got = [
        r[0]
        for r in df.select(
            tx.canonical_name(tx.collapse_whitespace(tx.F.lower("n")), rules.medication_patterns, rules.medication_aliases)
        ).collect()
    ]
    # "carbamazepine" is no part of "oxcarbazepine"
    assert got == ["levetiracetam", "valproate", "oxcarbazepine", None, None]


def test_patterns_win_in_configured_order(spark):
    df = spark.createDataFrame([("b and a",)], "n string")
    assert df.select(tx.canonical_name(tx.F.col("n"), ("b", "a"), ())).first()[0] == "b"


def test_whitespace_forms(spark):
    df = spark.createDataFrame([("  a\t\n b c \x1c",), ("  plain   text\t",)], "n string")
    got = [tuple(r) for r in df.select(tx.strip(tx.F.col("n")), tx.collapse_whitespace(tx.F.col("n"))).collect()]
    for (stripped, collapsed), raw in zip(got, ("  a\t\n b c \x1c", "  plain   text\t")):
        assert stripped == raw.strip() and collapsed == " ".join(raw.split())


def test_label_spellings(spark):
    df = spark.createDataFrame([(" TRUE",), ("y",), ("0",), ("No",), ("no",)], "likely_dre string")
    assert {r.label_class: r.row_count for r in label.class_counts(df).collect()} == {"0": 3, "1": 2}
    with pytest.raises(Exception, match="Unexpected label value: maybe"):
        label.class_counts(spark.createDataFrame([("maybe",)], "likely_dre string")).collect()


def test_same_result_as_brute_force(spark):
    """Random records against a direct per-patient evaluation."""
    import random
    from datetime import timedelta

    rng = random.Random(5)
    start = datetime(2024, 1, 1)
    names = ["keppra", "levetiracetam", "clobazam", "phenytoin", "aspirin", "valproate"]
    canonical = {"keppra": "levetiracetam", "valproate": "valproate", "aspirin": None}
    rx, ev = [], []
    for p in range(40):
        for _ in range(rng.randrange(6)):
            when = None if rng.random() < 0.2 else start + timedelta(days=rng.randrange(20))
            rx.append((f"p{p}", rng.choice(names), when))
        for _ in range(rng.randrange(5)):
            when = None if rng.random() < 0.2 else start + timedelta(days=rng.randrange(20))
            ev.append((f"p{p}", when))
    rx_df = spark.createDataFrame(rx, "patient_id string, medication_name string, medication_start timestamp_ntz")
    ev_df = spark.createDataFrame(ev, "patient_id string, event_time timestamp_ntz")
    got = by_patient(evidence.patient_evidence(None, rx_df, ev_df))
    for patient, row in got.items():
        plans = sorted(
            (t is None, t or datetime.max, canonical.get(n, n)) for p, n, t in rx if p == patient and canonical.get(n, n)
        )
        seen, anchor = [], None
        for missing, time, name in plans:
            if name not in seen:
                seen.append(name)
                if len(seen) == 2:
                    anchor = None if missing else time
        after = [t for p, t in ev if p == patient and anchor and t and t >= anchor]
        assert row.distinct_asm_count == len(seen)
        assert row.second_asm_start_time == anchor
        assert row.post_second_asm_event_count == len(after)
        assert row.first_post_second_asm_event_time == (min(after) if after else None)


def test_heavy_keys_are_split_without_changing_results(spark):
    """One key with two thirds of the rows: same rows as a plain join, and its partition is split."""
    from cohortweave.functions import skew

    facts = spark.range(60_000).selectExpr(
        "CASE WHEN id % 3 < 2 THEN 'hot' WHEN id % 30 = 2 THEN NULL ELSE concat('k', id % 50) END AS k", "id AS v"
    )
    lookup = spark.range(200).selectExpr("concat('k', id) AS k", "id AS w").unionByName(
        spark.sql("SELECT 'hot' AS k, 7L AS w")
    ).groupBy("k").agg(skew.F.max("w").alias("w"))
    for how in ("left", "inner", "left_anti"):
        joined = skew.lookup_join(facts, lookup, ["k"], how)
        assert sorted(map(str, joined.collect())) == sorted(map(str, facts.join(lookup, "k", how).select(*joined.columns).collect()))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "20",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k) for k in settings if spark.conf.get(k, None) is not None}
    try:
        for k, value in settings.items():
            spark.conf.set(k, value)
        joined = skew.lookup_join(facts.repartition(8), lookup, ["k"], "left")
        assert joined.count() == 60_000 and len(joined.collect()) == 60_000
        plan = joined._jdf.queryExecution().toString()
    finally:
        for k in settings:
            spark.conf.set(k, before[k]) if k in before else spark.conf.unset(k)
    assert "SortMergeJoin(skew=true)" in plan
