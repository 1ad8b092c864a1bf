"""Leakage-screened logistic regression on a patient table with Spark ML."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortweave.config import ModelConfig
from cohortweave.functions.ordering import exact_percentiles
from cohortweave.operators.leakage import MODALITY_FLAGS, LeakageReport, feature_columns, flag_columns, screen
from cohortweave.operators.metrics import evaluate
from cohortweave.operators.splits import SPLIT, existing_split, random_split, split_counts


@dataclass(frozen=True)
class TrainingResult:
    model: PipelineModel
    metrics: DataFrame
    leakage: LeakageReport
    features: list[str]
    flags: list[str]
    row_counts: dict[str, int]
    model_type: str
    notes: list[str]
    model_path: str | None = None
    metrics_path: str | None = None


def _as_double(column: str, dtype: T.DataType) -> str:
    """SQL for a feature as a double, with NaN as NULL and booleans as 0 / 1."""
    if isinstance(dtype, T.BooleanType):
        return f"cast(cast(`{column}` AS int) AS double)"
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return f"CASE WHEN NOT isnan(`{column}`) THEN cast(`{column}` AS double) END"
    return f"cast(`{column}` AS double)"


def validate_input(df: DataFrame, config: ModelConfig = ModelConfig()) -> list[str]:
    """Schema checks and one aggregate; returns notes or raises."""
    kind = "multimodal baseline" if config.fused else "baseline"
    if config.fused and df.isEmpty():
        raise ValueError(f"Cannot train {kind} model on an empty dataframe.")
    if config.target not in df.columns:
        raise ValueError(f"Missing target column: {config.target}")
    if config.patient_id not in df.columns:
        raise ValueError(f"Missing patient identifier column: {config.patient_id}")
    flags = [f for f in MODALITY_FLAGS if f in df.columns] if config.fused else []
    present = " + ".join(f"cast(coalesce({f}, false) AS int)" for f in flags) or "2"
    checks = df.agg(
        F.expr(f"count(`{config.target}`) AS targets"), F.expr(f"count_if({present} < 2) AS single")
    ).first()
    if checks.targets == 0:
        raise ValueError(f"Target column is all null: {config.target}")
    if flags and not config.allow_single_modality and checks.single:
        raise ValueError("Fused dataset contains rows with fewer than two available modalities.")
    if config.include_flags and flags:
        return ["modality availability flags found: " + ", ".join(flags)]
    return []


def single_modality_count(df: DataFrame) -> DataFrame:
    """Rows with fewer than two modalities, as one row."""
    flags = [f for f in MODALITY_FLAGS if f in df.columns]
    present = " + ".join(f"cast(coalesce({f}, false) AS int)" for f in flags) or "2"
    return df.agg(F.expr(f"count_if({present} < 2) AS single_modality_rows"))


def feature_statistics(df: DataFrame, features: list[str]) -> DataFrame:
    """Exact median per feature, then mean and population deviation after imputation.

    One row per feature with any value; a constant feature gets scale 1.
    """
    entries = ", ".join(
        f"named_struct('feature', '{c}', 'value', {_as_double(c, df.schema[c].dataType)})" for c in features
    )
    long = df.selectExpr(f"inline(array({entries}))")
    medians = exact_percentiles(long, ["feature"], "value", [0.5], ["median"])
    moments = long.groupBy("feature").agg(
        F.expr("count(1) AS n"),
        F.expr("count(value) AS m"),
        F.expr("avg(value) AS avg_value"),
        F.expr("var_pop(value) AS var_value"),
    )
    # Adding (n - m) copies of the median to m observed values.
    return (
        moments.join(medians, "feature")
        .selectExpr(
            "feature",
            "median",
            "(m * avg_value + (n - m) * median) / n AS mean",
            "m / n AS w",
            "avg_value",
            "var_value",
        )
        .selectExpr(
            "feature",
            "median",
            "mean",
            """sqrt(w * (var_value + (avg_value - mean) * (avg_value - mean))
                    + (1 - w) * (median - mean) * (median - mean)) AS deviation""",
        )
        .selectExpr("feature", "median", "mean", "CASE WHEN deviation = 0 THEN 1.0D ELSE deviation END AS scale")
    )


def class_weights(df: DataFrame, target: str = "likely_dre") -> DataFrame:
    """Balanced weights n / (2 n_c) per class."""
    counts = df.filter(f"`{target}` IS NOT NULL").groupBy(F.expr(f"cast(`{target}` AS int) AS label")).agg(
        F.expr("count(1) AS row_count")
    )
    classes = counts.agg(F.expr("sum(row_count) AS total"), F.expr("count(1) AS classes")).selectExpr(
        "cast(total AS double) / classes AS share"
    )
    return counts.withColumn("weight", classes.scalar() / F.col("row_count"))


def scaler(df: DataFrame, statistics: list, features: list[str]) -> tuple[SQLTransformer, list[str]]:
    """Imputation and scaling as one projection; features without statistics drop out."""
    by_name = {s.feature: s for s in statistics}
    used = [f for f in features if f in by_name]
    terms = []
    for i, name in enumerate(used):
        s = by_name[name]
        value = f"coalesce({_as_double(name, df.schema[name].dataType)}, {s.median!r}D)"
        terms.append(f"({value} - {s.mean!r}D) / {s.scale!r}D AS _feature_{i}")
    return SQLTransformer(statement=f"SELECT *, {', '.join(terms)} FROM __THIS__"), used


def fit_model(train: DataFrame, features: list[str], config: ModelConfig = ModelConfig()) -> tuple[PipelineModel, list[str]]:
    """Impute, scale and fit an L2 logistic regression on rows with ``label``."""
    if config.model_type != "logistic_regression":
        raise ValueError(f"Unsupported baseline model_type: {config.model_type}")
    row = train.agg(F.expr("count_if(label = 0) AS n0"), F.expr("count_if(label = 1) AS n1")).first()
    total = row.n0 + row.n1
    if config.fused and not total:
        raise ValueError("Training split has no rows.")
    if config.fused and not features:
        raise ValueError("Training split has no feature columns.")
    if not row.n0 or not row.n1:
        raise ValueError("Training split must contain at least two target classes.")
    # One row per feature: bounded by the table's width.
    projection, used = scaler(train, feature_statistics(train, features).collect(), features)
    assembler = VectorAssembler(inputCols=[f"_feature_{i}" for i in range(len(used))], outputCol="_features")
    weight = "1.0D"
    if config.balanced:
        weight = f"CASE WHEN label = 1 THEN {total / (2 * row.n1)!r}D ELSE {total / (2 * row.n0)!r}D END"
    prepared = assembler.transform(projection.transform(train)).selectExpr(
        "_features", "cast(label AS double) AS label", f"{weight} AS _weight"
    )
    # The mean loss plus regParam/2 |w|^2 is the usual C = 1 objective divided by n.
    estimator = LogisticRegression(
        featuresCol="_features",
        labelCol="label",
        weightCol="_weight",
        regParam=1.0 / total,
        elasticNetParam=0.0,
        standardization=False,
        maxIter=config.max_iter,
        tol=1e-9,
    )
    return PipelineModel([projection, assembler, estimator.fit(prepared)]), used


def score(model: PipelineModel, df: DataFrame, *columns: str) -> DataFrame:
    """Positive-class score and 0 / 1 prediction per row."""
    return model.transform(df).select(
        *columns,
        vector_to_array("probability")[1].alias("score"),
        F.col("prediction").cast("int").alias("prediction"),
    )


def train_baseline(df: DataFrame, config: ModelConfig = ModelConfig()) -> TrainingResult:
    """Validate, screen, split, fit and evaluate.

    The needed columns are kept (memory, then disk) while the fit passes over them.
    """
    notes = validate_input(df, config)
    if config.note:
        notes.append(config.note)
    report = screen(df, config)
    features = feature_columns(report, config)
    wanted = list(dict.fromkeys([config.patient_id, config.target, *features, *([config.split] if config.split else [])]))
    wanted = [c for c in wanted if c in df.columns]
    rows = df.select(*wanted).filter(F.col(config.target).isNotNull())
    rows = rows.withColumn("label", F.col(config.target).cast("int")).persist()
    try:
        if config.split and config.split in df.columns:
            assigned, split_notes = existing_split(rows, config.split), ["existing split column was used"]
            counts = split_counts(assigned)
            if not counts["train"]:
                raise ValueError("Existing split column produced an empty train split.")
            for name, word in (("val", "validation"), ("test", "test")):
                if not counts[name]:
                    split_notes.append(f"existing split column produced an empty {word} split")
        else:
            assigned, split_notes = random_split(rows, config)
            counts = split_counts(assigned)
        model, _ = fit_model(assigned.filter(f"{SPLIT} = 'train'"), features, config)
        scored = score(model, assigned.filter(f"{SPLIT} IS NOT NULL"), SPLIT, "label").withColumnRenamed(SPLIT, "split")
        table = evaluate(scored)
        metrics = df.sparkSession.createDataFrame(table.collect(), table.schema)  # three rows
    finally:
        rows.unpersist()
    return TrainingResult(
        model=model,
        metrics=metrics,
        leakage=report,
        features=features,
        flags=flag_columns(df, features) if config.fused else [],
        row_counts=counts,
        model_type=config.model_type,
        notes=list(dict.fromkeys([*notes, *report.notes, *split_notes])),
    )


def save_training(result: TrainingResult, folder: str) -> TrainingResult:
    """Write the fitted pipeline and its metrics under ``folder``."""
    from dataclasses import replace

    model_path, metrics_path = f"{folder.rstrip('/')}/model", f"{folder.rstrip('/')}/metrics"
    result.model.write().overwrite().save(model_path)
    result.metrics.coalesce(1).write.mode("overwrite").json(metrics_path)
    return replace(result, model_path=model_path, metrics_path=metrics_path)


def load_model(path: str) -> PipelineModel:
    """A pipeline that ``save_training`` wrote."""
    return PipelineModel.load(path)


def score_differences(first: PipelineModel, second: PipelineModel, df: DataFrame, config: ModelConfig = ModelConfig()) -> DataFrame:
    """Rows scored by two models, and how many of them differ in score or prediction, as one row.

    Scores of one row may differ by rounding where partitions differ, so both models score it in one pass.
    """
    rows = df.filter(F.col(config.target).isNotNull()).withColumn("label", F.col(config.target).cast("int"))
    own = [c for c in rows.columns if c not in ("features", "probability", "prediction", "rawPrediction")]
    scored = first.transform(rows).select(*own, F.struct("probability", "prediction").alias("_first"))
    again = second.transform(scored).select("_first", F.struct("probability", "prediction").alias("_second"))
    told = again.select(
        vector_to_array("_first.probability")[1].alias("a"),
        vector_to_array("_second.probability")[1].alias("b"),
        F.expr("_first.prediction <> _second.prediction AS moved"),
    )
    return told.agg(F.expr("count(1) AS row_count"), F.expr("count_if(NOT (a <=> b)) AS scores_differ"), F.expr("count_if(moved) AS predictions_differ"))
