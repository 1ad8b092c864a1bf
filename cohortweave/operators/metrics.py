"""Classification metrics as grouped aggregates.

Ranking metrics work on counts per distinct score with running totals, so no
window spans a whole split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.functions.ordering import running_totals

EMPTY_NOTE = "split is empty"
ONE_CLASS_NOTE = "roc_auc and average_precision undefined because split has one class"


def confusion_metrics(scored: DataFrame, split: str = "split") -> DataFrame:
    """Accuracy, precision, recall, F1 and positive rates per split.

    ``scored`` has integer columns ``label`` and ``prediction``. Undefined ratios are 0.
    """
    cells = scored.groupBy(split).agg(
        F.expr("count(1) AS row_count"),
        F.expr("count_if(label = 1 AND prediction = 1) AS tp"),
        F.expr("count_if(label = 0 AND prediction = 1) AS fp"),
        F.expr("count_if(label = 1 AND prediction = 0) AS fn"),
        F.expr("count_if(label = 0 AND prediction = 0) AS tn"),
    )
    return cells.selectExpr(
        split,
        "row_count",
        "(tp + tn) / row_count AS accuracy",
        "coalesce(tp / nullif(tp + fp, 0), 0.0D) AS precision",
        "coalesce(tp / nullif(tp + fn, 0), 0.0D) AS recall",
        "coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0D) AS f1",
        "(tp + fn) / row_count AS positive_rate_true",
        "(tp + fp) / row_count AS positive_rate_pred",
    )


def ranking_metrics(scored: DataFrame, split: str = "split") -> DataFrame:
    """Area under the ROC curve and step-wise average precision per two-class split.

    Ties in the score share one threshold. A split with one class gives no row.
    """
    counts = (
        scored.selectExpr(split, "cast(score AS double) AS value", "label")
        .groupBy(split, "value")
        .agg(F.expr("count_if(label = 1) AS pos"), F.expr("count_if(label = 0) AS neg"))
    )
    steps = running_totals(counts, [split], ["pos", "neg"], descending=True)
    return (
        steps.filter("pos_total > 0 AND neg_total > 0")
        .groupBy(split)
        .agg(
            F.expr(
                "sum(neg * (pos_before + pos / 2.0D) / (cast(pos_total AS double) * neg_total)) AS roc_auc"
            ),
            F.expr(
                """sum(pos / cast(pos_total AS double)
                       * (pos_before + pos) / (pos_before + pos + neg_before + neg)) AS average_precision"""
            ),
        )
    )


def evaluate(scored: DataFrame, split: str = "split", names: tuple[str, ...] = ("train", "val", "test")) -> DataFrame:
    """All metrics, one row per named split, with notes where some are undefined."""
    frame = scored.sparkSession.createDataFrame([(n,) for n in names], f"{split} string")
    return (
        frame.join(confusion_metrics(scored, split), split, "left")
        .join(ranking_metrics(scored, split), split, "left")
        .selectExpr(
            f"{split} AS split",
            "coalesce(row_count, 0) AS row_count",
            "accuracy",
            "precision",
            "recall",
            "f1",
            "roc_auc",
            "average_precision",
            "positive_rate_true",
            "positive_rate_pred",
            f"""array_compact(array(
                  CASE WHEN row_count IS NULL THEN '{EMPTY_NOTE}'
                       WHEN roc_auc IS NULL THEN '{ONE_CLASS_NOTE}' END)) AS notes""",
        )
    )
