"""Scoring, drift and what-if."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.columns import decide
from tidemark.operators import drift, scoring as s, validate as v
from tidemark.plans.catalog import query
from tidemark.plans.views import (
    CUSTOMERS_SQL, LOG_SQL, RULE_SCORE_SQL, SCORED_SQL, VALIDATED_SQL, customers, request_log, scored,
    scored_sql, validated, with_sql,
)
from tidemark.spec import SCORE_BOUNDS

RESPONSE = ["churn_prediction", "churn_probability", "confidence", "model_version", "prediction_id"]


@query("rule_score", with_sql(CUSTOMERS_SQL) + f'SELECT "customerID", {RULE_SCORE_SQL} score FROM customers')
def rule_score(spark: SparkSession, sf: str) -> DataFrame:
    return customers(spark, sf).select("customerID", s.rule_score().alias("score"))


@query("rule_score_noise", with_sql(CUSTOMERS_SQL) + f"""
SELECT count(*) n, 0::BIGINT AS outside FROM (SELECT {RULE_SCORE_SQL} score FROM customers)""")
def rule_score_noise(spark: SparkSession, sf: str) -> DataFrame:
    """Noise moves a score by at most 0.05 (before holding it within its limits)."""
    both = customers(spark, sf).select(s.rule_score().alias("plain"), s.rule_score(noise=0.05, seed=42).alias("noisy"))
    return both.agg(F.count(F.lit(1)).alias("n"),
                    F.count_if(F.abs(F.col("plain") - F.col("noisy")) > 0.05 + 1e-9).alias("outside"))


@query("score_batch", with_sql(SCORED_SQL) + f'SELECT "customerID", status, {", ".join(RESPONSE)} FROM scored')
def score_batch(spark: SparkSession, sf: str) -> DataFrame:
    return scored(spark, sf).select("customerID", "status", *RESPONSE)


@query("threshold_decision", with_sql(LOG_SQL) + """
SELECT event_id, score >= 0.8::DOUBLE AS decision FROM log""")
def threshold_decision(spark: SparkSession, sf: str) -> DataFrame:
    return request_log(spark, sf).select("event_id", decide("score", 0.8).alias("decision"))


@query("confidence_level", with_sql(LOG_SQL) + "SELECT event_id, score, confidence FROM log")
def confidence_level(spark: SparkSession, sf: str) -> DataFrame:
    return request_log(spark, sf).select("event_id", "score", "confidence")


@query("prediction_ids", with_sql(LOG_SQL) + "SELECT count(*) n, count(*) ids FROM log")
def prediction_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Every row gets its own random id."""
    return s.with_prediction_id(request_log(spark, sf)).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("prediction_id").alias("ids"))


@query("model_version_stamp", with_sql(LOG_SQL) + """
SELECT '3' AS model_version, count(*) n FROM log UNION ALL SELECT 'unknown', count(*) FROM log""")
def model_version_stamp(spark: SparkSession, sf: str) -> DataFrame:
    log = request_log(spark, sf)
    both = s.with_model_version(log, "3").unionByName(s.with_model_version(log, None))
    return both.groupBy("model_version").agg(F.count(F.lit(1)).alias("n"))


@query("score_domain_check", with_sql(SCORED_SQL) + """
SELECT count(churn_probability) rows_scored,
       count(*) FILTER (WHERE churn_probability < 0 OR churn_probability > 1) score_out_of_range,
       count(*) FILTER (WHERE churn_probability IS NOT NULL AND (confidence IS NULL OR confidence NOT IN ('high', 'medium', 'low'))) unknown_level
FROM scored""")
def score_domain_check(spark: SparkSession, sf: str) -> DataFrame:
    return v.check_scores(scored(spark, sf))


@query("outcome_counts", with_sql(VALIDATED_SQL) + """
SELECT count(*) FILTER (WHERE status = 'valid') success, count(*) FILTER (WHERE status <> 'valid') errors FROM validated""")
def outcome_counts(spark: SparkSession, sf: str) -> DataFrame:
    return s.outcome_counts(validated(spark, sf))


@query("batch_summary", with_sql(LOG_SQL) + """
SELECT batch_id, count(*) batch_size,
       floor((epoch_us(max(ts)) - epoch_us(min(ts)) + 5) / 10) / 100.0::DOUBLE processing_time_ms FROM log GROUP BY batch_id""")
def batch_summary(spark: SparkSession, sf: str) -> DataFrame:
    return s.batch_summary(request_log(spark, sf), "batch_id", "ts", "ts")


# --- drift ----------------------------------------------------------------------------------------

_SHIFTED_SQL = VALIDATED_SQL.rstrip() + """,
shifted_valid AS (
  SELECT * REPLACE (1 AS tenure, round("MonthlyCharges" * 3.0::DOUBLE, 2) AS "MonthlyCharges",
                    round(round("MonthlyCharges" * 3.0::DOUBLE, 2) * 1, 2) AS "TotalCharges",
                    'Month-to-month' AS "Contract", 'Electronic check' AS "PaymentMethod", 'Yes' AS "PaperlessBilling")
  FROM validated WHERE status = 'valid'),
both_cohorts AS (
  SELECT *, 'baseline' AS cohort FROM validated WHERE status = 'valid'
  UNION ALL SELECT *, 'shifted' FROM shifted_valid),""" + scored_sql("both_cohorts", "cohort_scores")


def cohort_scores(spark: SparkSession, sf: str) -> DataFrame:
    base = validated(spark, sf).where(F.col("status") == "valid")
    return s.score_batch(drift.with_shifted(base), version="1", key="customerID")


@query("what_if", with_sql(_SHIFTED_SQL) + """
SELECT "customerID", tenure, "MonthlyCharges", "TotalCharges", "Contract", "PaymentMethod", "PaperlessBilling" FROM shifted_valid""")
def what_if(spark: SparkSession, sf: str) -> DataFrame:
    base = validated(spark, sf).where(F.col("status") == "valid")
    return drift.shifted_cohort(base).select(
        "customerID", "tenure", "MonthlyCharges", "TotalCharges", "Contract", "PaymentMethod", "PaperlessBilling")


_STATS_SQL = _SHIFTED_SQL + """,
stats AS (
  SELECT cohort, count(churn_probability) success, count(*) FILTER (WHERE churn_probability IS NULL) errors,
         100 * (count(*) FILTER (WHERE churn_prediction))::DOUBLE / count(churn_probability) churn_rate_pct,
         avg(churn_probability) avg_probability FROM cohort_scores GROUP BY cohort)"""


@query("cohort_stats", with_sql(_STATS_SQL) + """
SELECT cohort, success, errors, round(churn_rate_pct, 9) churn_rate_pct, round(avg_probability, 9) avg_probability FROM stats""")
def cohort_stats(spark: SparkSession, sf: str) -> DataFrame:
    return drift.cohort_stats(cohort_scores(spark, sf)).withColumns(
        {"churn_rate_pct": F.round("churn_rate_pct", 9), "avg_probability": F.round("avg_probability", 9)})


@query("drift_report", with_sql(_STATS_SQL) + """
SELECT m.measure, round(m.b, 9) baseline, round(m.s, 9) shifted, round(m.s - m.b, 9) AS change FROM (
  SELECT 'churn_rate_pct' measure, max(churn_rate_pct) FILTER (WHERE cohort = 'baseline') b,
         max(churn_rate_pct) FILTER (WHERE cohort = 'shifted') s FROM stats
  UNION ALL SELECT 'avg_probability', max(avg_probability) FILTER (WHERE cohort = 'baseline'),
         max(avg_probability) FILTER (WHERE cohort = 'shifted') FROM stats) m""")
def drift_report(spark: SparkSession, sf: str) -> DataFrame:
    return drift.drift_report(cohort_scores(spark, sf)).withColumns(
        {c: F.round(c, 9) for c in ("baseline", "shifted", "change")})


def _share(test: str, cohort: str) -> str:
    return (f"count(*) FILTER (WHERE cohort = '{cohort}' AND {test})::DOUBLE / "
            f"nullif(count(churn_probability) FILTER (WHERE cohort = '{cohort}'), 0)")


_BUCKETS = [("score_le", str(float(b)), f"churn_probability <= {b}::DOUBLE") for b in SCORE_BOUNDS]
_BUCKETS += [("score_le", "+Inf", "churn_probability IS NOT NULL")]
_BUCKETS += [("level", lv, f"confidence = '{lv}'") for lv in ("high", "medium", "low")]


@query("distribution_shift", with_sql(_SHIFTED_SQL) + """
SELECT kind, bucket, round(b, 9) baseline_share, round(s, 9) shifted_share, round(s - b, 9) AS change FROM (
""" + " UNION ALL ".join(
    f"SELECT '{kind}' kind, '{bucket}' bucket, {_share(test, 'baseline')} b, {_share(test, 'shifted')} s FROM cohort_scores"
    for kind, bucket, test in _BUCKETS) + ")")
def distribution_shift(spark: SparkSession, sf: str) -> DataFrame:
    return drift.distribution_shift(cohort_scores(spark, sf)).withColumns(
        {c: F.round(c, 9) for c in ("baseline_share", "shifted_share", "change")})


@query("progress", with_sql(LOG_SQL) + """
SELECT handler, sent, total, 100 * churned::DOUBLE / sent churn_pct, score_sum::DOUBLE / sent avg_score,
       0::BIGINT errors
FROM (SELECT handler, row_number() OVER w sent, count(*) OVER (PARTITION BY handler) total,
             sum(CASE WHEN churn_prediction THEN 1 ELSE 0 END) OVER w churned, sum(CAST(score AS DECIMAL(5,2))) OVER w score_sum
      FROM log WINDOW w AS (PARTITION BY handler ORDER BY event_id ROWS UNBOUNDED PRECEDING))
WHERE sent % 50 = 0""")
def progress(spark: SparkSession, sf: str) -> DataFrame:
    log = request_log(spark, sf).withColumn("score", F.col("score").cast("decimal(5,2)"))
    return drift.progress(log, "event_id", 50, "handler", "score").withColumn("errors", F.col("errors").cast("bigint"))
