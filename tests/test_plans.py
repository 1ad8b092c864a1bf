"""Properties of physical plans that matter at scale."""

import os

import pytest

from cohortweave.plans.catalog import QUERIES

FOLDER = "/root/testdata/sf0.001"
# Queries that run a fit, a stream or whole jobs before they return.
EAGER = {
    "baseline_model",
    "csv_round_trip",
    "decode_errors",
    "decoded_files",
    "decoded_rows",
    "fusion_result",
    "image_job",
    "incremental_load",
    "incremental_rows",
    "load_metadata",
    "model_summary",
    "multimodal_job",
    "multimodal_patients",
    "participants_file",
    "random_split",
    "reloaded_model",
    "record_job",
    "signal_job",
    "split_audit",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cross_join_anywhere(spark):
    for name in sorted(set(QUERIES) - EAGER):
        plan = physical(QUERIES[name](spark, FOLDER))
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, name


def test_python_runs_only_in_the_spectral_kernel(spark):
    with_python = {"signal_bands", "recording_features", "patient_signal_mean", "signal_mixed_rates"}
    for name in sorted(set(QUERIES) - EAGER):
        plan = physical(QUERIES[name](spark, FOLDER))
        assert ("InArrow" in plan or "InPandas" in plan or "EvalPython" in plan) == (name in with_python), name


def test_scans_read_only_needed_columns(spark):
    plan = physical(QUERIES["patient_ids"](spark, FOLDER))
    assert "p_retailprice" not in plan and "l_extendedprice" not in plan
    plan = physical(QUERIES["profile_patient_count"](spark, FOLDER))
    assert "ReadSchema: struct<o_custkey:bigint>" in plan
