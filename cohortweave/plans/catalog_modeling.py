"""Registered queries for screening, splits, statistics, training and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortweave.config import ModelConfig
from cohortweave.operators import label, leakage, metrics, modeling, report, splits
from cohortweave.plans import views as v
from cohortweave.plans.registry import presented, register
from cohortweave.plans.sql_views import EVIDENCE, r6, with_blocks
from cohortweave.session import fresh_path

# --- patient table with a target -------------------------------------------------------------

_PATIENTS = """
    WITH t AS (
      SELECT CAST(c_custkey AS VARCHAR) AS patient_id, CASE WHEN c_acctbal > 3000 THEN 1 ELSE 0 END AS target,
             visits, CASE WHEN spend > 1000000 THEN spend END AS spend, largest, late, 1 AS constant
      FROM customer LEFT JOIN (
        SELECT o_custkey, count(*) AS visits, sum(o_totalprice) AS spend, max(o_totalprice) AS largest,
               max(o_orderstatus = 'F') AS late FROM orders GROUP BY 1) ON o_custkey = c_custkey)"""
FEATURES = ("visits", "spend", "largest", "late", "constant")


def modeling_table(spark: SparkSession, d: str) -> DataFrame:
    orders = v.table(spark, d, "orders").groupBy("o_custkey").agg(
        F.expr("count(1) AS visits"),
        F.expr("sum(o_totalprice) AS spend"),
        F.expr("max(o_totalprice) AS largest"),
        F.expr("max(o_orderstatus = 'F') AS late"),
    )
    return (
        v.table(spark, d, "customer")
        .join(orders, F.expr("o_custkey = c_custkey"), "left")
        .selectExpr(
            "cast(c_custkey AS string) AS patient_id",
            "CASE WHEN c_acctbal > 3000 THEN 1 ELSE 0 END AS target",
            "visits",
            "CASE WHEN spend > 1000000 THEN spend END AS spend",
            "largest",
            "late",
            "1 AS constant",
        )
    )


@register(
    "class_weights",
    f"""{_PATIENTS} SELECT target AS label, count(*) AS row_count,
            {r6('(SELECT count(*) FROM t) / 2.0::DOUBLE / count(*)')} AS weight FROM t GROUP BY target""",
)
def class_weights(spark: SparkSession, d: str) -> DataFrame:
    return presented(modeling.class_weights(modeling_table(spark, d), "target"))


@register(
    "impute_scale",
    f"{_PATIENTS} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, {r6('max(med)')} AS median, {r6('avg(w)')} AS mean,
                   {r6('CASE WHEN stddev_pop(w) = 0 THEN 1 ELSE stddev_pop(w) END')} AS scale
            FROM (SELECT m.med, coalesce(CAST({c} AS DOUBLE), m.med) AS w FROM t,
                  (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) AS med FROM t) AS m)"""
        for c in FEATURES
    ),
)
def impute_scale(spark: SparkSession, d: str) -> DataFrame:
    return presented(modeling.feature_statistics(modeling_table(spark, d), list(FEATURES)))


_SIZES = """n.n AS n, CAST(ceil(0.2 * n.n) AS BIGINT) AS test,
            CAST(ceil(0.125 * (n.n - ceil(0.2 * n.n))) AS BIGINT) AS val"""


@register(
    "random_split",
    f"""{_PATIENTS}, n AS (SELECT count(*) AS n FROM t), s AS (SELECT {_SIZES} FROM n)
        SELECT 'test' AS split, test AS row_count FROM s UNION ALL SELECT 'val', val FROM s
        UNION ALL SELECT 'train', n - test - val FROM s""",
)
def random_split(spark: SparkSession, d: str) -> DataFrame:
    assigned, _ = splits.random_split(modeling_table(spark, d), ModelConfig(target="target"))
    return assigned.groupBy(F.col(splits.SPLIT).alias("split")).agg(F.expr("count(1) AS row_count"))


def _kept(total: str, kept: str) -> tuple[str, str]:
    """SQL of the rows that each of two classes keeps: in proportion, the remainder to the larger fraction."""
    a, b = (f"(c{k} * {kept} // {total})" for k in (0, 1))
    part = [f"(c{k} * {kept} % {total})" for k in (0, 1)]
    rest = f"({kept} - {a} - {b})"
    return f"{a} + CASE WHEN {part[0]} >= {part[1]} THEN {rest} ELSE 0 END", f"{b} + CASE WHEN {part[0]} < {part[1]} THEN {rest} ELSE 0 END"


_K0, _K1 = _kept("n", "kept")


@register(
    "split_audit",
    f"""{_PATIENTS},
        n AS (SELECT count(*) FILTER (target = 0) AS c0, count(*) FILTER (target = 1) AS c1, count(*) AS n,
                     count(*) - CAST(ceil(0.2 * count(*)) AS BIGINT) AS kept FROM t),
        rest AS (SELECT c0 AS all0, c1 AS all1, {_K0} AS c0, {_K1} AS c1, kept AS n, kept - CAST(ceil(0.125 * kept) AS BIGINT) AS kept FROM n),
        sizes AS (SELECT *, {_K0} AS train0, {_K1} AS train1 FROM rest),
        strata AS (SELECT 0 AS stratum, 'test' AS split, all0 - c0 AS row_count FROM sizes UNION ALL SELECT 1, 'test', all1 - c1 FROM sizes
                   UNION ALL SELECT 0, 'val', c0 - train0 FROM sizes UNION ALL SELECT 1, 'val', c1 - train1 FROM sizes
                   UNION ALL SELECT 0, 'train', train0 FROM sizes UNION ALL SELECT 1, 'train', train1 FROM sizes),
        prints AS (SELECT target AS stratum, CAST(sum(CAST('0x' || substr(md5(patient_id), 1, 8) AS BIGINT)) AS BIGINT) AS stratum_fingerprint
                   FROM t GROUP BY 1)
        SELECT stratum, split, CAST(row_count AS BIGINT) AS row_count, 0::BIGINT AS shared_rows, true AS repeatable, stratum_fingerprint
        FROM strata JOIN prints USING (stratum)""",
)
def split_audit(spark: SparkSession, d: str) -> DataFrame:
    """Strata, disjointness and repeatability of the random split, the second time from other partitions."""
    config, rows = ModelConfig(target="target"), modeling_table(spark, d)
    first, again = (splits.random_split(df, config)[0] for df in (rows, rows.repartition(7, "largest")))
    return splits.split_audit(first, again, "patient_id", "target")


@register(
    "existing_split",
    """SELECT CASE WHEN s = 'train' THEN 'train' WHEN s IN ('val', 'valid', 'validation') THEN 'val'
                   WHEN s = 'test' THEN 'test' END AS split, count(*) AS row_count
       FROM (SELECT CASE c_mktsegment WHEN 'BUILDING' THEN 'train' WHEN 'AUTOMOBILE' THEN 'valid'
                         WHEN 'MACHINERY' THEN 'validation' WHEN 'HOUSEHOLD' THEN 'test' ELSE 'other' END AS s
             FROM customer) GROUP BY 1""",
)
def existing_split(spark: SparkSession, d: str) -> DataFrame:
    named = v.table(spark, d, "customer").selectExpr(
        """CASE c_mktsegment WHEN 'BUILDING' THEN 'Train' WHEN 'AUTOMOBILE' THEN 'VALID'
           WHEN 'MACHINERY' THEN 'Validation' WHEN 'HOUSEHOLD' THEN 'test' ELSE 'other' END AS word"""
    )
    return splits.existing_split(named, "word").groupBy(F.col(splits.SPLIT).alias("split")).agg(
        F.expr("count(1) AS row_count")
    )


# --- metrics on given scores -----------------------------------------------------------------

_SCORED = """
    WITH s AS (SELECT l_linestatus AS split, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
                      round(l_discount * 0.5 + l_tax + CASE WHEN l_returnflag = 'R' THEN 0.01 ELSE 0 END, 3) AS score
               FROM lineitem),
         p AS (SELECT *, CASE WHEN score > 0.07 THEN 1 ELSE 0 END AS prediction FROM s),
         c AS (SELECT split, score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg
               FROM p GROUP BY ALL),
         r AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY split) AS p_all,
                      sum(neg) OVER (PARTITION BY split) AS n_all
               FROM c WINDOW w AS (PARTITION BY split ORDER BY score DESC)),
         k AS (SELECT split, sum(neg * (tp - pos / 2.0::DOUBLE) / (p_all::DOUBLE * n_all)) AS roc_auc,
                      sum(pos / p_all::DOUBLE * tp / (tp + fp)) AS average_precision FROM r GROUP BY split),
         f AS (SELECT split, count(*) AS row_count, count(*) FILTER (label = 1 AND prediction = 1)::DOUBLE AS tp,
                      count(*) FILTER (label = 0 AND prediction = 1) AS fp,
                      count(*) FILTER (label = 1 AND prediction = 0) AS fn,
                      count(*) FILTER (label = 0 AND prediction = 0) AS tn FROM p GROUP BY split)"""
_CONFUSION = f"""split, row_count, {r6('(tp + tn) / row_count')} AS accuracy, {r6('tp / (tp + fp)')} AS precision,
    {r6('tp / (tp + fn)')} AS recall, {r6('2 * tp / (2 * tp + fp + fn)')} AS f1,
    {r6('(tp + fn) / row_count')} AS positive_rate_true, {r6('(tp + fp) / row_count')} AS positive_rate_pred"""


def scored_lines(spark: SparkSession, d: str) -> DataFrame:
    return (
        v.table(spark, d, "lineitem")
        .selectExpr(
            "l_linestatus AS split",
            "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label",
            "round(l_discount * 0.5D + l_tax + CASE WHEN l_returnflag = 'R' THEN 0.01D ELSE 0 END, 3) AS score",
        )
        .selectExpr("*", "CASE WHEN score > 0.07D THEN 1 ELSE 0 END AS prediction")
    )


@register("confusion_metrics", f"{_SCORED} SELECT {_CONFUSION} FROM f")
def confusion_metrics(spark: SparkSession, d: str) -> DataFrame:
    return presented(metrics.confusion_metrics(scored_lines(spark, d)))


@register(
    "average_precision",
    f"{_SCORED} SELECT split, {r6('roc_auc')} AS roc_auc, {r6('average_precision')} AS average_precision FROM k",
)
def average_precision(spark: SparkSession, d: str) -> DataFrame:
    return presented(metrics.ranking_metrics(scored_lines(spark, d)))


@register(
    "evaluate_splits",
    f"""{_SCORED} SELECT n.split, coalesce(row_count, 0) AS row_count, accuracy, precision, recall, f1,
            {r6('roc_auc')} AS roc_auc, {r6('average_precision')} AS average_precision, positive_rate_true,
            positive_rate_pred, CASE WHEN row_count IS NULL THEN 'split is empty' ELSE '' END AS notes
        FROM (VALUES ('F'), ('O'), ('none')) AS n(split) LEFT JOIN (SELECT {_CONFUSION} FROM f) AS g ON g.split = n.split
             LEFT JOIN k ON k.split = n.split""",
)
def evaluate_splits(spark: SparkSession, d: str) -> DataFrame:
    return presented(metrics.evaluate(scored_lines(spark, d), names=("F", "O", "none")))


_DECISIONS = (
    ("patient_id", "identifier", "count(*)"),
    ("likely_dre", "leakage", "count(*)"),
    ("definition_version", "leakage", "count(*)"),
    ("evidence_completeness_score", "kept", "count(*)"),
    ("epilepsy_evidence_status", "leakage", "count(*)"),
    ("asm_evidence_status", "leakage", "count(*)"),
    ("seizure_burden_status", "leakage", "count(*)"),
    ("has_epilepsy_diagnosis", "leakage", "count(*)"),
    ("has_recurrent_seizure_care", "leakage", "count(*)"),
    ("distinct_asm_count", "leakage", "count(*)"),
    ("has_two_or_more_distinct_asms", "leakage", "count(*)"),
    ("second_asm_start_time", "leakage", "count(anchor)"),
    ("post_second_asm_event_count", "leakage", "count(*)"),
    ("has_persistent_seizure_burden", "leakage", "count(*)"),
    ("reasons", "leakage", "count(*)"),
    ("missing_evidence", "leakage", "count(*)"),
    ("modality_sources", "leakage", "count(*)"),
)


@register(
    "leakage_screen",
    with_blocks(
        EVIDENCE,
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, '{decision}' AS decision, {count} AS non_null_rows FROM ruled"
            for c, decision, count in _DECISIONS
        ),
    ),
)
def leakage_screen(spark: SparkSession, d: str) -> DataFrame:
    """Decision per column of the label table, with its filled rows."""
    patients = label.patient_table(
        v.diagnoses(spark, d), v.medications(spark, d), v.seizure_events(spark, d), v.COLUMNS, v.RULES
    )
    decided = leakage.screen(patients).table(patients)
    filled = patients.agg(
        *[F.count_if(F.col(c).isNotNull()).alias(c) for c in patients.columns]
    ).unpivot([], patients.columns, "column_name", "non_null_rows")
    return decided.join(filled, "column_name")


@register("baseline_model")
def baseline_model(spark: SparkSession, d: str) -> DataFrame:
    """Training metrics per split."""
    result = modeling.train_baseline(modeling_table(spark, d), ModelConfig(target="target"))
    return presented(result.metrics)


@register("model_summary")
def model_summary(spark: SparkSession, d: str) -> DataFrame:
    """Test metrics, sizes and exclusions of a training run."""
    result = modeling.train_baseline(modeling_table(spark, d), ModelConfig(target="target"))
    summary = report.model_summary(result).select(
        "model_type",
        "train_row_count",
        "val_row_count",
        "test_row_count",
        "feature_cols_used",
        "key_metrics.*",
        "leakage_excluded_cols",
    )
    return presented(summary)


@register(
    "reloaded_model",
    f"{_PATIENTS} SELECT count(*) AS row_count, 0::BIGINT AS scores_differ, 0::BIGINT AS predictions_differ FROM t",
)
def reloaded_model(spark: SparkSession, d: str) -> DataFrame:
    """A trained pipeline, saved and loaded again, scores every row as before."""
    config, rows = ModelConfig(target="target"), modeling_table(spark, d)
    result = modeling.save_training(modeling.train_baseline(rows, config), fresh_path(spark, "training"))
    return modeling.score_differences(result.model, modeling.load_model(result.model_path), rows, config)


_SPLIT = "CASE WHEN {id} % 10 < 7 THEN 'train' WHEN {id} % 10 < 8 THEN 'val' ELSE 'test' END"


@register(
    "model_optimality",
    f"""{_PATIENTS}, counts AS (SELECT count(*) AS train_rows, sum(target) AS positives FROM t
            WHERE {_SPLIT.format(id="CAST(patient_id AS BIGINT)")} = 'train')
        SELECT term, train_rows, CAST(positives AS BIGINT) AS positives, 0.0 AS slope
        FROM counts, (SELECT unnest({list(("intercept", *FEATURES))!r}) AS term)""",
)
def model_optimality(spark: SparkSession, d: str) -> DataFrame:
    """Slope of the training objective at the fitted weights: 0 for each feature and the intercept.

    The objective is the class-weighted mean loss plus half the squared weights over the number of rows.
    """
    table = modeling_table(spark, d).withColumn("split", F.expr(_SPLIT.format(id="cast(patient_id AS bigint)")))
    result = modeling.train_baseline(table, ModelConfig(target="target", split="split"))
    weights = list(result.model.stages[-1].coefficients)
    train = table.filter("split = 'train'").withColumn("label", F.col("target"))
    sizes = train.agg(F.expr("count(1) AS n"), F.expr("sum(label) AS p")).first()
    scored = modeling.score(result.model, train, "label", *[f"_feature_{i}" for i in range(len(weights))])
    residual = f"(score - label) * CASE WHEN label = 1 THEN {sizes.n / (2 * sizes.p)!r}D ELSE {sizes.n / (2 * (sizes.n - sizes.p))!r}D END"
    slopes = [f"struct('intercept' AS term, avg({residual}) AS slope)"] + [
        f"struct('{name}' AS term, avg({residual} * _feature_{i}) + {float(w)!r}D / {sizes.n} AS slope)"
        for i, (name, w) in enumerate(zip(result.features, weights))
    ]
    return (
        scored.agg(F.expr("count(1) AS train_rows"), F.expr("sum(label) AS positives"), F.expr(f"array({', '.join(slopes)}) AS s"))
        .selectExpr("train_rows", "positives", "inline(s)")
        .selectExpr("term", "train_rows", "positives", "abs(round(slope, 4)) AS slope")
    )
