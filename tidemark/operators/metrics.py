"""Evaluation of scored rows: confusion counts, averaged metrics, ROC and AUC."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.columns import percentage
from tidemark.operators.running import running_totals


def _cell(label: str, prediction: str, actual: int, predicted: int) -> Column:
    return F.count_if((F.col(label) == actual) & (F.col(prediction) == predicted))


def confusion_matrix(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                     by: Sequence[str] = ()) -> DataFrame:
    """tp, tn, fp, fn, total and accuracy in percent, in one pass."""
    counts = pred.groupBy(*by).agg(
        _cell(label, prediction, 1, 1).alias("tp"), _cell(label, prediction, 0, 0).alias("tn"),
        _cell(label, prediction, 0, 1).alias("fp"), _cell(label, prediction, 1, 0).alias("fn"))
    return accuracy_of(counts.withColumn("total", F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")))


def accuracy_of(counts: DataFrame) -> DataFrame:
    """Percent of right predictions, one decimal, null without rows."""
    right = (F.col("tp") + F.col("tn")).cast("double")
    whole = F.when(F.col("total") > 0, F.col("total"))
    return counts.withColumn("accuracy_pct", percentage(right, whole, 1))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    return F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).otherwise(F.lit(0.0))


def metrics_from_counts(counts: DataFrame) -> DataFrame:
    """Accuracy, class-weighted precision, recall and F1, and those of the positive class,
    from tp, tn, fp, fn columns. Weighted recall equals accuracy."""
    tp, tn, fp, fn = (F.col(c).cast("double") for c in ("tp", "tn", "fp", "fn"))
    n, pos, neg = tp + tn + fp + fn, tp + fn, tn + fp
    precision1, recall1 = _ratio(tp, tp + fp), _ratio(tp, pos)
    precision0, recall0 = _ratio(tn, tn + fn), _ratio(tn, neg)

    def weighted(zero: Column, one: Column) -> Column:
        return _ratio(zero * neg + one * pos, n)

    return counts.withColumns({
        "accuracy": _ratio(tp + tn, n),
        "weighted_precision": weighted(precision0, precision1),
        "weighted_recall": weighted(recall0, recall1),
        "weighted_f1": weighted(_f1(precision0, recall0), _f1(precision1, recall1)),
        "precision": precision1, "recall": recall1, "f1": _f1(precision1, recall1)})


def classification_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                           by: Sequence[str] = ()) -> DataFrame:
    return metrics_from_counts(confusion_matrix(pred, label, prediction, by)).drop("accuracy_pct")


# --- ROC --------------------------------------------------------------------------------------

def score_counts(df: DataFrame, score: str, label: str, by: Sequence[str] = (),
                 bins: int | None = None, extra: Sequence[Column] = ()) -> DataFrame:
    """Positives and negatives per distinct score (or per score bin), counted before the shuffle.
    Rows without a score or label do not take part. ``extra`` adds aggregates per score."""
    value = F.floor(F.col(score) * bins) / bins if bins else F.col(score)
    usable = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    return (usable.withColumn("__score", value.cast("double")).groupBy(*by, F.col("__score").alias("score"))
            .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"), *extra))


def _accumulated(df: DataFrame, score: str, label: str, by: Sequence[str], bins: int | None,
                 extra: Sequence[Column] = ()) -> DataFrame:
    """Per distinct score the positives and negatives at or above it, and the group totals."""
    by = list(by)
    counts = score_counts(df, score, label, by, bins, extra)
    totals = {"pos": F.col("pos"), "neg": F.col("neg")}
    if bins is None:
        return running_totals(counts, "score", totals, by, descending=True)
    group = Window.partitionBy(*by)  # at most bins + 1 rows per group
    so_far = group.orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.select("*", *[F.sum(n).over(so_far).alias(f"{n}_run") for n in totals],
                         *[F.sum(n).over(group).alias(f"{n}_all") for n in totals])


def roc_curve(df: DataFrame, score: str, label: str, by: Sequence[str] = (), bins: int | None = None,
              baseline: bool = False) -> DataFrame:
    """ROC points (fpr, tpr), one per distinct score, starting at (0, 0).

    Tied scores share one point. A rate is 0 where its class is empty. With ``baseline``
    the two points of the random line are appended and ``series`` tells them apart. With ``by``,
    every group that has a row with score and label gets a curve; the fixed points come with the
    group's highest score, so the input is not read again for them.
    """
    by = list(by)

    def point(threshold: Column, fpr: Column, tpr: Column, series: str = "model") -> Column:
        named = [threshold.cast("double").alias("threshold"), fpr.alias("fpr"), tpr.alias("tpr")]
        return F.struct(*named, *([F.lit(series).alias("series")] if baseline else []))

    nowhere, zero, one = F.lit(None), F.lit(0.0), F.lit(1.0)
    fixed = [point(nowhere, zero, zero)]
    if baseline:
        fixed += [point(nowhere, zero, zero, "random"), point(nowhere, one, one, "random")]
    own = point(F.col("score"), _ratio(F.col("neg_run"), F.col("neg_all")), _ratio(F.col("pos_run"), F.col("pos_all")))
    counted = _accumulated(df, score, label, by, bins)
    if by:
        highest = F.col("pos_run") + F.col("neg_run") == F.col("pos") + F.col("neg")
        return counted.select(*by, F.inline(F.when(highest, F.array(*fixed, own)).otherwise(F.array(own))))
    start = df.sparkSession.range(1).select(F.inline(F.array(*fixed)))
    return start.unionByName(counted.select(F.inline(F.array(own))))


def auc_roc(df: DataFrame, score: str, label: str, by: Sequence[str] = (),
            bins: int | None = None) -> DataFrame:
    """Area under the ROC points by trapezoids; 0 where a class is empty."""
    area = F.sum(F.col("neg") * (F.col("pos_run") - F.col("pos") / 2))
    pairs = F.max("pos_all").cast("double") * F.max("neg_all")
    return _accumulated(df, score, label, by, bins).groupBy(*by).agg(
        F.max("pos_all").alias("positives"), F.max("neg_all").alias("negatives"),
        _ratio(area, pairs).alias("auc_roc"))


def class_totals(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.count_if(F.col(label) == 1).alias("positives"),
                               F.count_if(F.col(label) == 0).alias("negatives"))


def evaluate_groups(df: DataFrame, score: str, label: str, by: Sequence[str] = (),
                    threshold: float = 0.5, prediction: str | None = None) -> DataFrame:
    """AUC, confusion counts and averaged metrics of every group from one counting pass.

    A score counts as positive from ``threshold`` on, or as the ``prediction`` column says
    (equal scores have equal predictions).
    """
    extra = [] if prediction is None else [(F.max(prediction) == 1).alias("hit")]
    rows = _accumulated(df, score, label, by, None, extra)
    hit = F.col("hit") if prediction else F.col("score") >= threshold

    def cell(column: str, condition: Column) -> Column:
        return F.sum(F.when(condition, F.col(column)).otherwise(0))

    area = F.sum(F.col("neg") * (F.col("pos_run") - F.col("pos") / 2))
    pairs = F.max("pos_all").cast("double") * F.max("neg_all")
    return metrics_from_counts(rows.groupBy(*by).agg(
        cell("pos", hit).alias("tp"), cell("neg", ~hit).alias("tn"),
        cell("neg", hit).alias("fp"), cell("pos", ~hit).alias("fn"), _ratio(area, pairs).alias("auc_roc")))
