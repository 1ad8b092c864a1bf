"""Linkage, fusion, profile and reports on small literal tables."""

import math

import pytest

from cohortweave.config import FusionConfig, LinkageConfig, RunContext
from cohortweave.operators import fusion, linkage, profile, report

RUN = RunContext("run-001", "project", "stage", "2025-01-01T00:00:00", seed=3)


# --- linkage ---------------------------------------------------------------------------------


def test_mapping_link(spark):
    df = spark.createDataFrame([(" a ", 1), ("b", 2), ("zz", 3), ("  ", 4), (None, 5), ("dup", 6)], "source_id string, v int")
    mapping = spark.createDataFrame(
        [("a", "P1"), ("b ", " P2"), ("dup", "P3"), (" dup", "P4"), ("blank", " "), (None, "P9")],
        "source_id string, canonical_patient_id string",
    )
    config = LinkageConfig("source_id")
    linked = linkage.link(df, config, mapping)
    rows = {r.v: r for r in linkage.linked_table(linked, config).collect()}
    assert [rows[k].patient_id for k in range(1, 7)] == ["P1", "P2", None, None, None, None]
    assert rows[1].source_id == " a "
    records = linkage.link_records(linked, "ehr")
    statuses = sorted((r.source_id, r.match_status, r.notes or "") for r in records.collect())
    assert statuses == [
        ("", "unmatched", linkage.NOTE_MISSING),
        ("", "unmatched", linkage.NOTE_MISSING),
        ("a", "matched", ""),
        ("b", "matched", ""),
        ("dup", "ambiguous", linkage.NOTE_CONFLICT),
        ("zz", "unmatched", linkage.NOTE_ABSENT),
    ]
    counts = linkage.link_counts(records, note="config note").first()
    assert (counts.row_count, counts.matched_count, counts.unmatched_count, counts.ambiguous_count) == (6, 2, 3, 1)
    assert counts.notes == ["config note", "3 ehr rows were unmatched", "1 ehr rows were ambiguous"]


def test_empty_mapping_still_dispatches_to_mapping(spark):
    df = spark.createDataFrame([("a",)], "source_id string")
    row = linkage.link_records(linkage.link(df, LinkageConfig("source_id"), {}), "ehr").first()
    assert (row.match_status, row.match_method) == ("unmatched", "explicit_mapping")


def test_normalisation_link(spark):
    df = spark.createDataFrame([(" Sub-01 ",), ("",), (None,)], "subject_id string")
    config = LinkageConfig("subject_id", mode="lower", keep_source=False)
    linked = linkage.link(df, config)
    assert linkage.linked_table(linked, config).columns == ["patient_id"]
    assert sorted(r.source_id for r in linkage.link_records(linked, "mri").collect()) == ["", "", "sub-01"]
    in_place = LinkageConfig("patient_id", output_id="patient_id")
    renamed = df.withColumnRenamed("subject_id", "patient_id")
    assert linkage.linked_table(linkage.link(renamed, in_place), in_place).columns == ["patient_id"]
    with pytest.raises(ValueError, match="normalization_mode"):
        linkage.link(df, LinkageConfig("subject_id", mode="soundex"))
    with pytest.raises(ValueError, match="Missing source identifier column"):
        linkage.link(df, LinkageConfig("nope"))


def test_link_summary(spark):
    df = spark.createDataFrame([("a",), (" ",)], "s string")
    parts = [linkage.link_counts(linkage.link_records(linkage.link(df, LinkageConfig("s")), m)) for m in ("mri", "eeg")]
    rows = {r.source_modality: r for r in linkage.link_summary(parts).collect()}
    assert rows[None].modality_count == 2 and rows[None].row_count == 4 and rows[None].unmatched_count == 2
    assert rows["mri"].matched_count == 1


# --- fusion ----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def sides(spark):
    ehr = spark.createDataFrame(
        [("p1", 30, True, 1.0), ("p2", 40, False, 2.0)], "patient_id string, age int, likely_dre boolean, shared double"
    )
    mri = spark.createDataFrame([(0.5, "p2", 7.0), (0.1, None, 8.0)], "lesion_score double, patient_id string, shared double")
    eeg = spark.createDataFrame([("p3", 1.5), (None, 2.5)], "patient_id string, shared double")
    return ehr, mri, eeg


def test_fused_table(sides):
    built = fusion.fused_dataset(*sides)
    assert built.table.columns == [
        "patient_id", "has_ehr", "has_mri", "has_eeg", "ehr_age", "ehr_likely_dre", "ehr_shared",
        "mri_lesion_score", "mri_shared", "eeg_shared",
    ]
    rows = {r.patient_id: r for r in built.table.collect()}
    assert set(rows) == {"p1", "p2", "p3", None}
    assert (rows["p2"].ehr_shared, rows["p2"].mri_shared, rows["p2"].eeg_shared) == (2.0, 7.0, None)
    assert (rows[None].has_mri, rows[None].has_eeg, rows[None].has_ehr) == (True, True, False)  # NULL ids meet
    assert built.notes == [
        "mri dataframe contains missing patient identifiers",
        "eeg dataframe contains missing patient identifiers",
    ]
    counts = fusion.fusion_result(built.table).first()
    assert (counts.row_count, counts.patient_count, counts.patients_with_mri) == (4, 3, 2)
    assert counts.patients_with_all_modalities == 0


def test_absent_sides_and_flags(spark, sides):
    built = fusion.fused_dataset(sides[0], None, spark.createDataFrame([], "patient_id string, x int"))
    assert built.notes == ["mri dataframe was not provided", "eeg dataframe was empty"]
    row = built.table.first()
    assert (row.has_ehr, row.has_mri, row.has_eeg) == (True, False, False)
    bare = fusion.fused_dataset(*sides, config=FusionConfig(include_flags=False)).table
    assert not [c for c in bare.columns if c.startswith("has_")]
    nothing = fusion.fused_dataset(None, None, None, spark=spark)
    assert nothing.table.columns == ["patient_id"] and nothing.table.count() == 0
    assert fusion.modality_counts(nothing.table).first().patients_with_ehr == 0


def test_duplicates_and_missing_ids(spark, sides):
    twice = spark.createDataFrame([("p1", 1.0), ("p1", 2.0), (None, 3.0), (None, 4.0)], "patient_id string, f double")
    with pytest.raises(ValueError, match="mri dataframe contains duplicate patient_id values: 2"):
        fusion.fused_dataset(sides[0], twice)
    with pytest.raises(Exception, match="contains duplicate patient_id values"):
        fusion.fuse({"ehr": sides[0], "mri": twice}).collect()
    no_id = spark.createDataFrame([(1.0,)], "f double")
    with pytest.raises(ValueError, match="missing required column: patient_id"):
        fusion.fused_dataset(sides[0], no_id)
    lenient = fusion.fused_dataset(sides[0], no_id, config=FusionConfig(require_patient_id=False))
    assert "mri dataframe is missing required column: patient_id" in lenient.notes


# --- profile ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(
        [
            ("p1", 1, "train", 10.0, "a", "2025-01-01", True),
            ("p2", 0, "train", float("nan"), "b", "bad", False),
            ("p2", 1, "test", 30.0, "a", "2025-03-01", None),
            ("p3", None, None, None, "a", None, True),
        ],
        "patient_id string, label bigint, split string, age double, source string, event_time string, flag boolean",
    )


def test_missingness(frame):
    rows = {r.column_name: r for r in profile.missingness(frame).collect()}
    assert rows["age"].missing_count == 2 and rows["age"].missing_fraction == 0.5
    assert rows["patient_id"].missing_count == 0
    empty = profile.missingness(frame.limit(0)).collect()
    assert {r.missing_fraction for r in empty} == {0.0}


def test_balances(frame):
    labels = {r.label_value: (r["count"], r.fraction) for r in profile.class_balance(frame, "label").collect()}
    assert labels == {"1": (2, 0.5), "0": (1, 0.25), "nan": (1, 0.25)}
    flags = {r.split_value: r["count"] for r in profile.split_balance(frame, "flag").collect()}
    assert flags == {"True": 2, "False": 1, "nan": 1}


def test_numeric_summary(frame):
    rows = {r.column_name: r for r in profile.numeric_summaries(frame).collect()}
    age = rows["age"]
    assert (age.non_null_count, age.mean, age.median, age.p25) == (2, 20.0, 20.0, 15.0)
    assert age.std == pytest.approx(math.sqrt(200))
    text = {r.column_name: r for r in profile.numeric_summaries(frame, ["source", "label", "gone"]).collect()}
    assert text["source"].non_null_count == 0 and text["source"].median is None and set(text) == {"source", "label"}


def test_single_value_has_no_deviation(spark):
    row = profile.numeric_summaries(spark.createDataFrame([(1.0,)], "x double")).first()
    assert row.std is None and row.median == 1.0


def test_categories_break_ties_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "v string")
    rows = profile.category_cardinality(df, top_n=2).orderBy("place").collect()
    assert [(r.value, r["count"], r.unique_count) for r in rows] == [("c", 2, 3), ("a", 1, 3)]


def test_times(frame):
    row = profile.temporal_coverage(frame, ["event_time"]).first()
    assert row.non_null_count == 2 and str(row.min_time) == "2025-01-01 00:00:00"
    assert profile.temporal_coverage(frame).count() == 0


def test_whole_profile_and_summary(frame):
    profiled = profile.profile(frame, "set", "patient_id", "label", "split", times=["event_time", "gone"])
    overview = profiled.overview.first()
    assert (overview.row_count, overview.column_count, overview.patient_count) == (4, 7, 3)
    assert profiled.notes == ["requested time_cols missing: gone"]
    assert {"missingness", "class_balance", "split_balance"} <= set(profiled.sections())
    summary = profile.profile_summary(profiled, 2).first()
    assert summary.class_balance["1"] == 2 and summary.split_balance["train"] == 2
    assert [r.column_name for r in summary.top_missing_columns] == ["age", "event_time"]
    bare = profile.profile_summary(profile.profile(frame, "set")).first()
    assert bare.class_balance == {} and bare.patient_count is None


# --- reports ---------------------------------------------------------------------------------


def test_manifest_and_registry(spark, frame):
    described = report.dataset_descriptor(frame, "set", metadata={"label_column": "label"})
    row = described.first()
    assert (row.row_count, row.patient_count, row.metadata["label_column"]) == (4, 3, "label")
    registry = report.artifacts(spark, RUN, "job", [("t", "table", "t", None), ("j", "json", "j", "text")])
    assert [r.artifact_name for r in report.artifacts_of_type(registry, "json").collect()] == ["j"]
    manifest = report.run_manifest(RUN, report.run_datasets(RUN, described), registry, ["a", "b", "a"]).first()
    assert manifest.notes == ["a", "b"] and [a.artifact_name for a in manifest.artifacts] == ["t", "j"]
    assert manifest.run_context.seed == 3


def test_bundle(spark, frame):
    counts = spark.createDataFrame([(10, 3)], "patient_dataset_row_count int, likely_dre_positive_count int")
    pipeline = report.pipeline_summary(RUN, counts, "set", {"table": "/t", "none": None}, ["n", "n"])
    assert pipeline.first().artifact_paths == {"table": "/t"}
    bundle = report.reporting_bundle(pipeline, None, profile.profile(frame, "set"), ["x"]).first()
    assert bundle.pipeline_summary.patient_dataset_row_count == 10 and bundle.model_summary is None
    assert bundle.dataset_profile_summary.row_count == 4 and bundle.notes == ["x"]


def test_a_profile_scans_its_input_twice(spark, frame, tmp_path):
    """Once for the wide aggregate, once for the value counts; the sections read neither."""
    frame.write.parquet(f"{tmp_path}/rows")
    scans = spark.sparkContext.accumulator(0)

    def passed(batches):
        scans.add(1)
        yield from batches

    counted = spark.read.parquet(f"{tmp_path}/rows").coalesce(1).mapInArrow(passed, frame.schema)
    profiled = profile.profile(counted, "set", "patient_id", "label", "split", times=["event_time"])
    assert scans.value == 2
    plain = profile.profile(spark.read.parquet(f"{tmp_path}/rows").coalesce(1), "set", "patient_id", "label", "split", times=["event_time"])
    for name, section in profiled.sections().items():
        assert sorted(map(str, section.collect())) == sorted(map(str, plain.sections()[name].collect()))
    assert scans.value == 2
    assert profiled.overview.first().patient_count == 3
    bare = profile.profile(spark.createDataFrame([], "a array<int>"), "none")
    assert bare.overview.first().row_count == 0 and bare.numeric.count() == 0 and bare.categories.count() == 0
