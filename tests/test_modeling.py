"""Screening, splits, fit and metrics."""

import numpy as np
import pytest

from pyspark.sql import functions as F

from cohortweave.config import ModelConfig, fused_model_config
from cohortweave.operators import leakage, metrics, modeling, report, splits


def record_frame(spark, n=40, split=None):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(n):
        y = i % 2
        name = None if split is None else split(i)
        rows.append((f"p{i}", y, int(40 + 5 * y + rng.integers(0, 9)), int(rng.integers(1, 6)), bool(y), 2, "text", name))
    return spark.createDataFrame(
        rows,
        "patient_id string, likely_dre int, age bigint, encounter_count bigint, has_epilepsy_diagnosis boolean, "
        "distinct_asm_count bigint, reasons string, split string",
    )


def test_record_screen(spark):
    report_ = leakage.screen(record_frame(spark), ModelConfig(split="split", exclude=("age",), features=None))
    assert report_.kept == ["encounter_count"]
    assert report_.leakage == ["likely_dre", "has_epilepsy_diagnosis", "distinct_asm_count", "reasons"]
    assert report_.identifier == ["patient_id", "split"] and report_.configured == ["age"]
    assert report_.notes == ["target-derived leakage-sensitive columns were excluded"]
    with pytest.raises(ValueError, match="No safe numeric feature columns remain"):
        leakage.feature_columns(leakage.screen(record_frame(spark), ModelConfig(features=("reasons",))))


def test_fused_screen(spark):
    df = spark.createDataFrame(
        [], "patient_id string, ehr_likely_dre int, EHR_Reasons_count int, ehr_distinct_asm_count int, ehr_x double, "
        "mri_text string, has_ehr boolean, ehr_evidence_completeness_score double"
    )
    config = fused_model_config(include_flags=False)
    found = leakage.screen(df, config)
    assert found.kept == ["ehr_x", "ehr_evidence_completeness_score"]
    assert found.configured == ["has_ehr"] and found.non_numeric == ["mri_text"]
    assert found.leakage == ["ehr_likely_dre", "EHR_Reasons_count", "ehr_distinct_asm_count"]
    assert leakage.screen(df, fused_model_config(strict_leakage=True)).kept == ["ehr_x", "has_ehr"]
    assert ("has_ehr", "configured") in {(r.column_name, r.decision) for r in found.table(df).collect()}


@pytest.mark.parametrize("n", [40, 41, 97])
def test_random_split_sizes_and_strata(spark, n):
    df = spark.createDataFrame([(f"p{i}", int(i % 3 == 0)) for i in range(n)], "patient_id string, likely_dre int")
    assigned, notes = splits.random_split(df, ModelConfig())
    rows = assigned.collect()
    test = int(np.ceil(0.2 * n))
    val = int(np.ceil(0.125 * (n - test)))
    sizes = {s: sum(r._split == s for r in rows) for s in ("train", "val", "test")}
    assert sizes == {"test": test, "val": val, "train": n - test - val}
    share = np.mean([r.likely_dre for r in rows if r._split == "test"])
    assert abs(share - 1 / 3) < 0.1
    again = {r.patient_id: r._split for r in splits.random_split(df.repartition(7), ModelConfig())[0].collect()}
    assert again == {r.patient_id: r._split for r in rows}  # partitioning does not matter
    other = {r.patient_id: r._split for r in splits.random_split(df, ModelConfig(seed=1))[0].collect()}
    assert other != again and notes == ["random train validation test split was created"]


def test_split_fallbacks(spark):
    small = spark.createDataFrame([(f"p{i}", i % 2) for i in range(4)], "patient_id string, ehr_likely_dre int")
    assigned, notes = splits.random_split(small, fused_model_config())
    assert {r._split for r in assigned.collect()} == {"train"} and "too small" in notes[1]
    lone = spark.createDataFrame([(f"p{i}", int(i == 0)) for i in range(20)], "patient_id string, likely_dre int")
    assigned, notes = splits.random_split(lone, ModelConfig())
    assert splits.split_counts(assigned) == {"train": 14, "val": 2, "test": 4}
    assert "stratified split skipped because class support was insufficient" in notes


def test_allocation():
    assert splits.allocate([30, 10], 32) == [24, 8]
    assert sum(splits.allocate([7, 6], 10)) == 10
    with pytest.raises(ValueError, match="greater or equal to the number of classes"):
        splits.holdout_quota([3, 3], 0.1, True)


def test_fit_matches_newton(spark):
    """The objective is C = 1 logistic loss with balanced weights on scaled, imputed features."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(120, 3)) * [1, 10, 0.1] + [0, 5, 1]
    y = (x[:, 0] + 0.1 * x[:, 1] + rng.normal(size=120) > 1).astype(int)
    holes = rng.random(120) < 0.2
    rows = [
        (f"p{i}", int(y[i]), float(x[i, 0]), None if holes[i] else float(x[i, 1]), float(x[i, 2]), 1.0) for i in range(120)
    ]
    df = spark.createDataFrame(rows, "patient_id string, label int, a double, b double, c double, k double")
    model, used = modeling.fit_model(df, ["a", "b", "c", "k"], ModelConfig())
    filled = x.copy()
    filled[holes, 1] = np.median(x[~holes, 1])
    z = (filled - filled.mean(0)) / filled.std(0)
    design = np.column_stack([z, np.zeros(120), np.ones(120)])
    weight = np.where(y == 1, 120 / (2 * y.sum()), 120 / (2 * (120 - y.sum())))
    ridge = np.diag([1.0, 1, 1, 1, 0])
    w = np.zeros(5)
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ w))
        gradient = design.T @ (weight * (p - y)) + ridge @ w
        w -= np.linalg.solve(design.T @ (design * (weight * p * (1 - p))[:, None]) + ridge, gradient)
    fitted = model.stages[-1]
    assert used == ["a", "b", "c", "k"]
    assert np.allclose(fitted.coefficients.toArray(), w[:4], atol=1e-4) and fitted.intercept == pytest.approx(w[4], abs=1e-4)


def test_statistics(spark):
    df = spark.createDataFrame([(1.0, None, True), (3.0, None, False), (None, None, True)], "a double, b double, c boolean")
    rows = {r.feature: r for r in modeling.feature_statistics(df, ["a", "b", "c"]).collect()}
    assert set(rows) == {"a", "c"}  # a feature without any value has no median
    assert (rows["a"].median, rows["a"].mean) == (2.0, 2.0)
    assert rows["a"].scale == pytest.approx(np.std([1, 3, 2]))
    assert rows["c"].scale == pytest.approx(np.std([1, 0, 1]))


def test_train_with_existing_split(spark, tmp_path):
    def name(i):
        return ("TRAIN", "Valid", "test")[0 if i < 20 else 1 if i < 25 else 2] if i < 30 else "other"

    df = record_frame(spark, 40, name)
    result = modeling.train_baseline(df, ModelConfig(split="split"))
    assert result.row_counts == {"train": 20, "val": 5, "test": 5} and result.features == ["age", "encounter_count"]
    rows = {r.split: r for r in result.metrics.collect()}
    assert rows["train"].row_count == 20 and 0 <= rows["train"].roc_auc <= 1
    saved = modeling.save_training(result, str(tmp_path))
    assert spark.read.json(saved.metrics_path).count() == 3
    from pyspark.ml import PipelineModel

    again = PipelineModel.load(saved.model_path)
    assert modeling.score(again, df, "patient_id").count() == 40
    summary = report.model_summary(saved).first()
    assert summary.key_metrics.test_accuracy == rows["test"].accuracy and summary.model_path == saved.model_path
    assert summary.leakage_excluded_cols == result.leakage.leakage


def test_train_random_is_deterministic_and_imputes(spark):
    rng = np.random.default_rng(1)
    rows = [
        (f"p{i}", i % 2, float(rng.normal() + i % 2), None if i % 4 else float(rng.normal()), True, i % 3 == 0, i % 5 == 0)
        for i in range(30)
    ]
    df = spark.createDataFrame(
        rows, "patient_id string, ehr_likely_dre int, mri_x double, eeg_y double, has_ehr boolean, has_mri boolean, has_eeg boolean"
    )
    first, second = (modeling.train_baseline(df, fused_model_config()) for _ in range(2))
    assert first.metrics.collect() == second.metrics.collect()
    assert first.flags == ["has_ehr", "has_mri", "has_eeg"]
    assert "modality availability flags found: has_ehr, has_mri, has_eeg" in first.notes
    with pytest.raises(ValueError, match="fewer than two available modalities"):
        modeling.train_baseline(df, fused_model_config(allow_single_modality=False))


def test_input_errors(spark):
    df = record_frame(spark)
    for config, message in (
        (ModelConfig(target="gone"), "Missing target column"),
        (ModelConfig(patient_id="gone"), "Missing patient identifier column"),
        (ModelConfig(model_type="forest"), "Unsupported baseline model_type"),
    ):
        with pytest.raises(ValueError, match=message):
            modeling.train_baseline(df, config)
    with pytest.raises(ValueError, match="all null"):
        modeling.validate_input(df.selectExpr("patient_id", "cast(NULL AS int) AS likely_dre"))
    with pytest.raises(ValueError, match="empty dataframe"):
        modeling.validate_input(df.limit(0).withColumnRenamed("likely_dre", "ehr_likely_dre"), fused_model_config())
    with pytest.raises(ValueError, match="two target classes"):
        modeling.fit_model(df.filter("likely_dre = 1").withColumn("label", df.likely_dre), ["age"])


def test_metrics_against_definitions(spark):
    rng = np.random.default_rng(6)
    y = rng.integers(0, 2, 300)
    s = np.round(rng.random(300) * 0.7 + 0.3 * y * rng.random(300), 2)
    rows = [("a", int(t), float(v), int(v > 0.5)) for t, v in zip(y, s)] + [("one", 1, 0.4, 0), ("one", 1, 0.9, 1)]
    df = spark.createDataFrame(rows, "split string, label int, score double, prediction int")
    got = {r.split: r for r in metrics.evaluate(df, names=("a", "one", "none")).collect()}
    pos, neg = s[y == 1], s[y == 0]
    auc = np.mean((pos[:, None] > neg[None, :]) + 0.5 * (pos[:, None] == neg[None, :]))
    ap, hit = 0.0, 0
    for v in sorted(set(s), reverse=True):
        now = (pos >= v).sum()
        ap += (now - hit) / pos.size * now / (s >= v).sum()
        hit = now
    assert got["a"].roc_auc == pytest.approx(auc) and got["a"].average_precision == pytest.approx(ap)
    assert got["a"].accuracy == pytest.approx(((s > 0.5) == y).mean())
    assert got["one"].notes == [metrics.ONE_CLASS_NOTE] and got["one"].roc_auc is None and got["one"].recall == 0.5
    assert got["none"].row_count == 0 and got["none"].accuracy is None and got["none"].notes == [metrics.EMPTY_NOTE]


def test_undefined_ratios_are_zero(spark):
    df = spark.createDataFrame([("a", 0, 0), ("a", 0, 0)], "split string, label int, prediction int")
    row = metrics.confusion_metrics(df).first()
    assert (row.precision, row.recall, row.f1, row.accuracy) == (0.0, 0.0, 0.0, 1.0)


def test_class_weights(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "likely_dre int")
    assert {r.label: r.weight for r in modeling.class_weights(df).collect()} == {1: 2.0, 0: pytest.approx(2 / 3)}


def test_split_audit_sees_faults(spark):
    first = spark.createDataFrame([("a", 0, "train"), ("b", 0, "test"), ("c", 1, "train"), ("c", 1, "test")], f"id string, y int, {splits.SPLIT} string")
    again = first.withColumn(splits.SPLIT, F.expr(f"if(id = 'a', 'test', if(id = 'b', 'train', {splits.SPLIT}))"))
    rows = {(r.stratum, r.split): r for r in splits.split_audit(first, again, "id", "y").collect()}
    assert {k: (r.row_count, r.shared_rows, r.repeatable) for k, r in rows.items()} == {
        (0, "train"): (1, 0, False), (0, "test"): (1, 0, False), (1, "train"): (1, 1, True), (1, "test"): (1, 1, True)
    }
    lost = splits.split_audit(first, first.filter("id <> 'b'"), "id", "y").filter("NOT repeatable").collect()
    assert [(r.stratum, r.split) for r in lost] == [(0, "test")]


def test_differences_between_models(spark, tmp_path):
    rows = record_frame(spark)
    one = modeling.save_training(modeling.train_baseline(rows), str(tmp_path))
    two = modeling.train_baseline(rows, ModelConfig(balanced=False, max_iter=1))
    loaded = modeling.load_model(one.model_path)
    same = modeling.score_differences(one.model, loaded, rows).first()
    assert (same.row_count, same.scores_differ, same.predictions_differ) == (rows.count(), 0, 0)
    other = modeling.score_differences(one.model, two.model, rows).first()
    assert other.scores_differ > 0
