"""Confusion counts, metrics, ROC and AUC of scored rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators import metrics as m
from tidemark.plans.catalog import query
from tidemark.plans.views import RULE_SCORES_SQL, SUPPLIER_RUNS_SQL, rule_name, rule_scores, supplier_runs, table, with_sql

PRICE_TOP = 110000.0

_CELLS_SQL = RULE_SCORES_SQL.rstrip() + """,
cells AS (
  SELECT algorithm, count(*) FILTER (WHERE label = 1 AND prediction = 1) tp,
         count(*) FILTER (WHERE label = 0 AND prediction = 0) tn,
         count(*) FILTER (WHERE label = 0 AND prediction = 1) fp,
         count(*) FILTER (WHERE label = 1 AND prediction = 0) fn FROM rule_scores GROUP BY algorithm)"""


def named_scores(spark: SparkSession, sf: str) -> DataFrame:
    return rule_scores(spark, sf).withColumn("algorithm", rule_name(0))


@query("confusion_matrix", with_sql(_CELLS_SQL) + """
SELECT algorithm, tp, tn, fp, fn, tp + tn + fp + fn AS total,
       round((tp + tn)::DOUBLE / (tp + tn + fp + fn) * 100, 1) accuracy_pct FROM cells""")
def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return m.confusion_matrix(named_scores(spark, sf), by=["algorithm"])


@query("classification_metrics", with_sql(_CELLS_SQL + """,
parts AS (
  SELECT algorithm, tp::DOUBLE tp, tn::DOUBLE tn, fp::DOUBLE fp, fn::DOUBLE fn,
         CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0 END p1, CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0 END r1,
         CASE WHEN tn + fn > 0 THEN tn::DOUBLE / (tn + fn) ELSE 0 END p0, CASE WHEN tn + fp > 0 THEN tn::DOUBLE / (tn + fp) ELSE 0 END r0
  FROM cells),
scores AS (SELECT *, CASE WHEN p1 + r1 > 0 THEN 2 * p1 * r1 / (p1 + r1) ELSE 0 END f11,
                  CASE WHEN p0 + r0 > 0 THEN 2 * p0 * r0 / (p0 + r0) ELSE 0 END f10 FROM parts)""") + """
SELECT algorithm, round((tp + tn) / (tp + tn + fp + fn), 6) accuracy,
       round((p0 * (tn + fp) + p1 * (tp + fn)) / (tp + tn + fp + fn), 6) weighted_precision,
       round((r0 * (tn + fp) + r1 * (tp + fn)) / (tp + tn + fp + fn), 6) weighted_recall,
       round((f10 * (tn + fp) + f11 * (tp + fn)) / (tp + tn + fp + fn), 6) weighted_f1,
       round(p1, 6) AS "precision", round(r1, 6) recall, round(f11, 6) f1 FROM scores""")
def classification_metrics(spark: SparkSession, sf: str) -> DataFrame:
    out = m.classification_metrics(named_scores(spark, sf), by=["algorithm"])
    names = ["accuracy", "weighted_precision", "weighted_recall", "weighted_f1", "precision", "recall", "f1"]
    return out.select("algorithm", *[F.round(n, 6).alias(n) for n in names])


@query("class_totals", with_sql(RULE_SCORES_SQL) + """
SELECT algorithm, count(*) FILTER (WHERE label = 1) positives, count(*) FILTER (WHERE label = 0) negatives
FROM rule_scores GROUP BY algorithm""")
def class_totals(spark: SparkSession, sf: str) -> DataFrame:
    return m.class_totals(named_scores(spark, sf), "label", ["algorithm"])


def priced(spark: SparkSession, sf: str) -> DataFrame:
    """Line items scored by price: nearly every row has its own score."""
    lines = table(spark, sf, "lineitem").where(F.col("l_returnflag").isin("A", "R"))
    return lines.select((F.col("l_extendedprice") / F.lit(PRICE_TOP)).alias("score"),
                        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"))


_PRICED_SQL = f"""
priced AS (SELECT l_extendedprice / {PRICE_TOP}::DOUBLE score, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END label
           FROM lineitem WHERE l_returnflag IN ('A', 'R'))"""


def _curve_sql(score: str) -> str:
    return _PRICED_SQL + f""",
counts AS (SELECT {score} score, sum(label) pos, sum(1 - label) neg FROM priced GROUP BY 1),
curve AS (
  SELECT score threshold, sum(neg) OVER w / (SELECT sum(neg) FROM counts)::DOUBLE fpr,
         sum(pos) OVER w / (SELECT sum(pos) FROM counts)::DOUBLE tpr
  FROM counts WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT NULL, 0.0, 0.0)"""


@query("roc_curve", with_sql(_curve_sql("score")) + "SELECT * FROM curve")
def roc_curve(spark: SparkSession, sf: str) -> DataFrame:
    return m.roc_curve(priced(spark, sf), "score", "label")


@query("roc_curve_binned", with_sql(_curve_sql("floor(score * 1000) / 1000")) + "SELECT * FROM curve")
def roc_curve_binned(spark: SparkSession, sf: str) -> DataFrame:
    return m.roc_curve(priced(spark, sf), "score", "label", bins=1000)


@query("roc_baseline", with_sql(_curve_sql("floor(score * 100) / 100")) + """
SELECT *, 'model' AS series FROM curve UNION ALL SELECT NULL, 0.0, 0.0, 'random' UNION ALL SELECT NULL, 1.0, 1.0, 'random'""")
def roc_baseline(spark: SparkSession, sf: str) -> DataFrame:
    return m.roc_curve(priced(spark, sf), "score", "label", bins=100, baseline=True)


def _auc_sql(source: str, score: str, by: str = "") -> str:
    lead, part = (f"{by}, ", f"PARTITION BY {by} ") if by else ("", "")
    return f"""
tied AS (SELECT {lead}{score} score, sum(label)::DOUBLE pos, sum(1 - label)::DOUBLE neg FROM {source} GROUP BY ALL),
ranked AS (SELECT *, sum(pos) OVER ({part}ORDER BY score DESC ROWS UNBOUNDED PRECEDING) run FROM tied)
SELECT {lead}sum(pos)::BIGINT positives, sum(neg)::BIGINT negatives,
       round(sum(neg * (run - pos / 2.0::DOUBLE)) / (sum(pos) * sum(neg)), 9) auc_roc FROM ranked {'GROUP BY ' + by if by else ''}"""


@query("auc_roc", "WITH " + _PRICED_SQL.strip() + "," + _auc_sql("priced", "score"))
def auc_roc(spark: SparkSession, sf: str) -> DataFrame:
    return m.auc_roc(priced(spark, sf), "score", "label").withColumn("auc_roc", F.round("auc_roc", 9))


@query("auc_roc_by_algorithm", "WITH " + RULE_SCORES_SQL.strip() + "," + _auc_sql("rule_scores", "score", "algorithm"))
def auc_roc_by_algorithm(spark: SparkSession, sf: str) -> DataFrame:
    return m.auc_roc(named_scores(spark, sf), "score", "label", ["algorithm"]).withColumn("auc_roc", F.round("auc_roc", 9))


@query("auc_roc_binned", "WITH " + _PRICED_SQL.strip() + "," + _auc_sql("priced", "floor(score * 1000) / 1000"))
def auc_roc_binned(spark: SparkSession, sf: str) -> DataFrame:
    return m.auc_roc(priced(spark, sf), "score", "label", bins=1000).withColumn("auc_roc", F.round("auc_roc", 9))


@query("supplier_runs", with_sql(SUPPLIER_RUNS_SQL) + "SELECT * FROM supplier_runs")
def all_supplier_runs(spark: SparkSession, sf: str) -> DataFrame:
    return supplier_runs(spark, sf).withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))
