"""Scoring rows: the additive rule score, decisions, bands, ids and batch summaries.

Everything here works on batch and streaming DataFrames alike.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.columns import (
    clamp, confidence_level, decide, elapsed_ms, noise as noise_column, positive_score, round_score,
)


@dataclass(frozen=True)
class Term:
    """Weight of one feature: the first case that holds, else ``otherwise``.

    Cases are (comparison, operand, weight); ``default`` replaces a missing value.
    """

    column: str
    cases: tuple[tuple[str, object, float], ...]
    otherwise: float = 0.0
    default: object = None


_COMPARE: dict[str, Callable[[Column, object], Column]] = {
    "==": lambda c, v: c == F.lit(v), "<=": lambda c, v: c <= F.lit(v), ">": lambda c, v: c > F.lit(v),
    "<": lambda c, v: c < F.lit(v), ">=": lambda c, v: c >= F.lit(v),
}

# --- Fixed values: weights of the customer rule score, in the order they are added --------------
CUSTOMER_RULES: tuple[Term, ...] = (
    Term("Contract", (("==", "Month-to-month", 0.30), ("==", "One year", 0.10)), 0.02, "Month-to-month"),
    Term("tenure", (("<=", 6, 0.20), ("<=", 12, 0.12), ("<=", 24, 0.06)), 0.01, 12),
    Term("MonthlyCharges", ((">", 90, 0.12), (">", 70, 0.08), (">", 50, 0.04)), 0.01, 65.0),
    Term("InternetService", (("==", "Fiber optic", 0.10), ("==", "DSL", 0.03)), 0.0, "DSL"),
    Term("PaymentMethod", (("==", "Electronic check", 0.08),), 0.02, "Mailed check"),
    Term("OnlineSecurity", (("==", "Yes", -0.05),)),
    Term("TechSupport", (("==", "Yes", -0.05),)),
    Term("PaperlessBilling", (("==", "Yes", 0.03),)),
    Term("SeniorCitizen", (("==", 1, 0.04),)),
)


def term_weight(term: Term) -> Column:
    value = F.col(term.column)
    if term.default is not None:
        value = F.coalesce(value, F.lit(term.default))
    out = None
    for op, operand, weight in term.cases:
        test = _COMPARE[op](value, operand)
        out = F.when(test, F.lit(weight)) if out is None else out.when(test, F.lit(weight))
    return out.otherwise(F.lit(term.otherwise))


def rule_score(rules: Sequence[Term] = CUSTOMER_RULES, noise: float = 0.0,
               seed: int | None = None) -> Column:
    """Sum of the term weights, with optional noise, held within [0.01, 0.99]."""
    total = F.lit(0.0)
    for term in rules:
        total = total + term_weight(term)
    if noise:
        total = total + noise_column(noise, seed)
    return clamp(total)


def with_prediction_id(df: DataFrame, deterministic_key: str | None = None,
                       out: str = "prediction_id") -> DataFrame:
    """A uuid per row, or with a key the same id for the same key on every run."""
    value = F.md5(F.col(deterministic_key).cast("string")) if deterministic_key else F.expr("uuid()")
    return df.withColumn(out, value)


def with_model_version(df: DataFrame, version: str | None, out: str = "model_version") -> DataFrame:
    return df.withColumn(out, F.coalesce(F.lit(version).cast("string"), F.lit("unknown")))


def decorate(scored: DataFrame, raw_score: str, version: str | None = None, key: str | None = None,
             threshold: float = 0.5, decided_on: str | None = None) -> DataFrame:
    """The response columns: decision, rounded score, band, version, id. The decision looks at the
    raw score unless ``decided_on`` names another column, such as a model's prediction."""
    out = scored.withColumns({
        "churn_prediction": decide(decided_on or raw_score, threshold), "churn_probability": round_score(raw_score)})
    if decided_on:
        out = out.drop(decided_on)
    out = out.withColumn("confidence", confidence_level("churn_probability")).drop(raw_score)
    return with_prediction_id(with_model_version(out, version), key)


def score_batch(df: DataFrame, rules: Sequence[Term] = CUSTOMER_RULES, version: str | None = None,
                key: str | None = None, noise: float = 0.0, seed: int | None = None) -> DataFrame:
    """Score every row; rows marked ``status = 'invalid'`` stay, with an empty score."""
    score = rule_score(rules, noise, seed)
    if "status" in df.columns:
        score = F.when(F.col("status") == "valid", score)
    return decorate(df.withColumn("__score", score), "__score", version, key)


def keeping_all_rows(model: PipelineModel) -> PipelineModel:
    """The same fitted model, but rows with missing numbers pass through instead of vanishing."""
    return PipelineModel([
        s.copy({s.handleInvalid: "keep"}) if isinstance(s, VectorAssembler) else s for s in model.stages])


def score_with_model(df: DataFrame, model: PipelineModel, numeric: Sequence[str],
                     version: str | None = None, key: str | None = None) -> DataFrame:
    """Score rows with a fitted model: one output row per input row, input columns kept.

    The model's prediction is the decision. A row that is marked invalid or lacks one of the
    ``numeric`` features gets an empty score and no decision.
    """
    names = list(df.columns)
    usable = F.lit(True)
    for c in numeric:
        usable = usable & F.col(c).isNotNull()
    if "status" in names:
        usable = usable & (F.col("status") == "valid")
    out = keeping_all_rows(model).transform(df).select(
        *names, F.when(usable, positive_score()).alias("__score"),
        F.when(usable, F.col("prediction")).alias("__decision"))
    return decorate(out, "__score", version, key, decided_on="__decision")


def batch_summary(scored: DataFrame, batch: str, start: str, end: str) -> DataFrame:
    """Rows and processing time of each batch."""
    return scored.groupBy(batch).agg(
        F.count(F.lit(1)).alias("batch_size"),
        elapsed_ms(F.min(start), F.max(end)).alias("processing_time_ms"))


def outcome_counts(scored: DataFrame, status: str = "status") -> DataFrame:
    """Rows that were scored and rows that were rejected."""
    return scored.agg(F.count_if(F.col(status) == "valid").alias("success"),
                      F.count_if(F.col(status) != "valid").alias("errors"))
