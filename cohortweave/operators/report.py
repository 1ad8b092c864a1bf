"""Descriptors, run tables and summaries as DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortweave.config import RunContext
from cohortweave.operators.modeling import TrainingResult
from cohortweave.operators.profile import Profile, profile_summary
from cohortweave.schemas import RUN_ARTIFACTS, RUN_DATASETS


def _strings(items: Sequence[str]):
    return F.array(*[F.lit(i) for i in items]).cast("array<string>")


def _map(entries: Mapping[str, str]):
    flat = [F.lit(part) for pair in entries.items() for part in pair]
    return F.create_map(*flat).cast("map<string,string>") if flat else F.expr("cast(map() AS map<string,string>)")


def dataset_descriptor(
    df: DataFrame,
    dataset_name: str,
    modality: str = "ehr",
    source_format: str = "parquet",
    description: str | None = None,
    metadata: Mapping[str, str] | None = None,
    patient_id: str = "patient_id",
) -> DataFrame:
    """One descriptor row: rows, patients, modality and free-form metadata."""
    patients = f"count(DISTINCT `{patient_id}`)" if patient_id in df.columns else "count(1)"
    return df.agg(F.expr("count(1) AS row_count"), F.expr(f"{patients} AS patient_count")).select(
        F.lit(dataset_name).alias("dataset_name"),
        F.lit(modality).alias("modality"),
        F.lit(source_format).alias("source_format"),
        "row_count",
        "patient_count",
        F.lit(description).cast("string").alias("description"),
        _map(metadata or {}).alias("metadata"),
    )


def artifacts(
    spark: SparkSession,
    run: RunContext,
    created_by: str,
    entries: Sequence[tuple[str, str, str, str | None]],
) -> DataFrame:
    """Artifact rows from ``(name, type, relative path, description)``, in order."""
    rows = [(run.run_id, i, name, kind, path, text, created_by, {}) for i, (name, kind, path, text) in enumerate(entries)]
    return spark.createDataFrame(rows, RUN_ARTIFACTS)


def artifacts_of_type(registry: DataFrame, artifact_type: str) -> DataFrame:
    return registry.filter(F.col("artifact_type") == artifact_type).orderBy("position")


def run_datasets(run: RunContext, *descriptors: DataFrame) -> DataFrame:
    rows = descriptors[0]
    for more in descriptors[1:]:
        rows = rows.unionByName(more)
    return rows.select(F.lit(run.run_id).alias("run_id"), *[f.name for f in RUN_DATASETS if f.name != "run_id"])


def run_manifest(run: RunContext, datasets: DataFrame, registry: DataFrame, notes: Sequence[str]) -> DataFrame:
    """One manifest row per run: context, datasets, artifacts and distinct notes in order.

    Both lists hold a handful of records that the job itself registered.
    """
    context = F.struct(
        *[
            (_map(value) if isinstance(value, dict) else F.lit(value)).alias(name)
            for name, value in asdict(run).items()
        ]
    )
    listed = datasets.filter(F.col("run_id") == run.run_id).groupBy("run_id").agg(
        F.expr("sort_array(collect_list(struct(dataset_name, modality, source_format, row_count, patient_count))) AS datasets")
    )
    registered = registry.filter(F.col("run_id") == run.run_id).groupBy("run_id").agg(
        F.expr("sort_array(collect_list(struct(position, artifact_name, artifact_type, relative_path, description))) AS artifacts")
    )
    return listed.join(registered, "run_id", "full_outer").select(
        "run_id",
        context.alias("run_context"),
        "datasets",
        "artifacts",
        F.array_distinct(_strings(list(notes))).alias("notes"),
    )


# Summary name -> metric of the test split.
KEY_METRICS = {
    "test_accuracy": "accuracy",
    "test_f1": "f1",
    "test_precision": "precision",
    "test_recall": "recall",
    "test_roc_auc": "roc_auc",
    "test_average_precision": "average_precision",
}


def model_summary(result: TrainingResult) -> DataFrame:
    """One row with the test metrics, sizes, features and leakage exclusions."""
    test = result.metrics.filter("split = 'test'")
    return test.select(
        F.lit(result.model_type).alias("model_type"),
        *[F.lit(result.row_counts[s]).cast("bigint").alias(f"{s}_row_count") for s in ("train", "val", "test")],
        _strings(result.features).alias("feature_cols_used"),
        F.lit(result.model_path).cast("string").alias("model_path"),
        F.lit(result.metrics_path).cast("string").alias("metrics_path"),
        F.struct(*[F.col(metric).alias(name) for name, metric in KEY_METRICS.items()]).alias("key_metrics"),
        _strings(result.leakage.leakage).alias("leakage_excluded_cols"),
        _strings(result.notes).alias("notes"),
    )


def pipeline_summary(
    run: RunContext,
    counts: DataFrame,
    dataset_name: str | None,
    artifact_paths: Mapping[str, str | None],
    notes: Sequence[str],
) -> DataFrame:
    """One row: run identity, the given one-row counts, artifact paths and notes."""
    paths = {name: path for name, path in artifact_paths.items() if path is not None}
    return counts.select(
        F.lit(run.run_id).alias("run_id"),
        F.lit(run.project_name).alias("project_name"),
        F.lit(run.stage_name).alias("stage_name"),
        F.lit(dataset_name).cast("string").alias("dataset_name"),
        *counts.columns,
        _map(paths).alias("artifact_paths"),
        _strings(list(dict.fromkeys(notes))).alias("notes"),
    )


def reporting_bundle(
    pipeline: DataFrame | None = None,
    model: DataFrame | None = None,
    profiled: Profile | None = None,
    notes: Sequence[str] = (),
) -> DataFrame:
    """One row holding the available one-row summaries as structs; absent ones are NULL."""
    parts = {
        "pipeline_summary": pipeline,
        "model_summary": model,
        "dataset_profile_summary": None if profiled is None else profile_summary(profiled),
    }
    given = {name: df for name, df in parts.items() if df is not None}
    if not given:
        raise ValueError("A reporting bundle needs at least one summary.")
    first, *rest = given
    bundle = given[first].select(F.struct("*").alias(first))
    for name in rest:
        bundle = bundle.withColumn(name, given[name].select(F.struct("*").alias(name)).scalar())
    for name in parts:
        if name not in given:
            bundle = bundle.withColumn(name, F.lit(None).cast("string"))
    return bundle.select(*parts).withColumn("notes", _strings(list(dict.fromkeys(notes))))
