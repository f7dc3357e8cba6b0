"""Dashboard measures over the request log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators import monitor as mon, validate as v
from tidemark.plans.catalog import query
from tidemark.plans.views import LOG_SQL, covered_sql, request_log, with_sql
from tidemark.spec import BATCH_BOUNDS, LATENCY_BOUNDS, LEVELS, SCORE_BOUNDS

JOB = "fastapi"
HOUR = 3600


def live(spark: SparkSession, sf: str) -> DataFrame:
    """The log of the serving job only."""
    return request_log(spark, sf).where(F.col("job") == JOB)


LIVE_SQL = LOG_SQL.rstrip() + f", live AS (SELECT * FROM log WHERE job = '{JOB}')"


def _ranged(range_s: int, step_s: int) -> str:
    return LIVE_SQL + f", ranged AS (SELECT *, {covered_sql(range_s, step_s)} FROM live)"


@query("request_rate", with_sql(_ranged(HOUR, HOUR // 4)) + """
SELECT window_start, method, handler, status, count(*) n, count(*) / 3600.0::DOUBLE per_second FROM ranged GROUP BY ALL""")
def request_rate(spark: SparkSession, sf: str) -> DataFrame:
    return mon.rate(live(spark, sf), ["method", "handler", "status"], "1 hour", "15 minutes")


@query("request_rate_minute", with_sql(_ranged(60, 15)) + """
SELECT window_start, method, handler, status, count(*) n, count(*) / 60.0::DOUBLE per_second FROM ranged GROUP BY ALL""")
def request_rate_minute(spark: SparkSession, sf: str) -> DataFrame:
    return mon.rate(live(spark, sf), ["method", "handler", "status"])


@query("prediction_rate", with_sql(_ranged(5 * HOUR, HOUR)) + """
SELECT window_start, churn_prediction, count(*) n, count(*) / 18000.0::DOUBLE per_second FROM ranged GROUP BY ALL""")
def prediction_rate(spark: SparkSession, sf: str) -> DataFrame:
    return mon.rate(live(spark, sf), ["churn_prediction"], "5 hours", "1 hour")


@query("latency_quantiles", with_sql(_ranged(5 * HOUR, HOUR)) + """
SELECT window_start, count(*) n, round(quantile_cont(latency_s, 0.5), 6) p50, round(quantile_cont(latency_s, 0.95), 6) p95
FROM ranged GROUP BY window_start""")
def latency_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    out = mon.latency_quantiles(live(spark, sf), (0.5, 0.95), "5 hours", "1 hour")
    return out.withColumns({c: F.round(c, 6) for c in ("p50", "p95")})


@query("latency_quantiles_approx")
def latency_quantiles_approx(spark: SparkSession, sf: str) -> DataFrame:
    return mon.latency_quantiles(live(spark, sf), (0.5, 0.95), "5 hours", "1 hour", exact=False)


@query("error_rate", with_sql(_ranged(5 * HOUR, HOUR)) + """
SELECT window_start, count(*) n, count(*) FILTER (WHERE status >= 400) errors,
       round(100 * (count(*) FILTER (WHERE status >= 400))::DOUBLE / count(*), 9) error_pct FROM ranged GROUP BY window_start""")
def error_rate(spark: SparkSession, sf: str) -> DataFrame:
    return mon.error_rate(live(spark, sf), "5 hours", "1 hour").withColumn("error_pct", F.round("error_pct", 9))


def _silent_sql(counts: str, step_s: int, keys: str = "") -> str:
    """Every range between the first and the last of a series; ``counts`` is a table with window_start and the keys."""
    lead = f"{keys}, " if keys else ""
    group = f" GROUP BY {keys}" if keys else ""
    return f"""every AS (SELECT {lead}unnest(generate_series(min(window_start), max(window_start), INTERVAL {step_s} SECOND)) AS window_start
FROM {counts}{group})"""


@query("error_rate_silent", with_sql(_ranged(HOUR, HOUR // 4) + """, counts AS (SELECT window_start, handler, count(*) n,
  count(*) FILTER (WHERE status >= 400) errors FROM ranged GROUP BY ALL), """ + _silent_sql("counts", HOUR // 4, "handler")) + """
SELECT window_start, handler, coalesce(n, 0)::BIGINT n, coalesce(errors, 0)::BIGINT errors,
       round(coalesce(100 * errors::DOUBLE / n, 0), 9)::DOUBLE error_pct
FROM every LEFT JOIN counts USING (window_start, handler)""")
def error_rate_silent(spark: SparkSession, sf: str) -> DataFrame:
    """Zero where a handler was silent."""
    out = mon.error_rate(live(spark, sf), "1 hour", "15 minutes", ["handler"], silent=True)
    return out.withColumn("error_pct", F.round("error_pct", 9))


@query("request_rate_silent", with_sql(_ranged(60, 15) + """, counts AS (SELECT window_start, method, count(*) n
  FROM ranged GROUP BY ALL), """ + _silent_sql("counts", 15, "method")) + """
SELECT window_start, method, coalesce(n, 0)::BIGINT n, coalesce(n, 0) / 60.0::DOUBLE per_second
FROM every LEFT JOIN counts USING (window_start, method)""")
def request_rate_silent(spark: SparkSession, sf: str) -> DataFrame:
    return mon.rate(live(spark, sf), ["method"], silent=True)


@query("latency_quantiles_by", with_sql(_ranged(5 * HOUR, HOUR)) + """
SELECT window_start, handler, count(*) n, round(quantile_cont(latency_s, 0.05), 6) p5, round(quantile_cont(latency_s, 0.99), 6) p99
FROM ranged GROUP BY window_start, handler""")
def latency_quantiles_by(spark: SparkSession, sf: str) -> DataFrame:
    out = mon.latency_quantiles(live(spark, sf), (0.05, 0.99), "5 hours", "1 hour", ["handler"])
    return out.withColumns({c: F.round(c, 6) for c in ("p5", "p99")})


@query("total_error_rate", with_sql(LIVE_SQL) + """
SELECT count(*) n, count(*) FILTER (WHERE status >= 400) errors,
       round(100 * (count(*) FILTER (WHERE status >= 400))::DOUBLE / count(*), 9) error_pct FROM live""")
def total_error_rate(spark: SparkSession, sf: str) -> DataFrame:
    return mon.total_error_rate(live(spark, sf)).withColumn("error_pct", F.round("error_pct", 9))


@query("total_requests", with_sql(LIVE_SQL) + "SELECT count(*) requests FROM live")
def total_requests(spark: SparkSession, sf: str) -> DataFrame:
    return mon.totals(live(spark, sf))


@query("avg_latency", with_sql(_ranged(5 * HOUR, HOUR)) + """
SELECT window_start, handler, count(*) n, sum(CAST(latency_s AS DECIMAL(10,4)))::DOUBLE latency_sum, sum(CAST(latency_s AS DECIMAL(10,4)))::DOUBLE / count(*) avg_latency
FROM ranged GROUP BY ALL""")
def avg_latency(spark: SparkSession, sf: str) -> DataFrame:
    log = live(spark, sf).withColumn("latency_s", F.col("latency_s").cast("decimal(10,4)"))
    return mon.avg_latency(log, "5 hours", "1 hour", ["handler"]).withColumn(
        "latency_sum", F.col("latency_sum").cast("double"))


@query("prediction_counts", with_sql(LOG_SQL) + """
SELECT CASE WHEN churn_prediction THEN 'true' ELSE 'false' END prediction, count(*) predictions FROM log
WHERE churn_prediction IS NOT NULL GROUP BY 1""")
def prediction_counts(spark: SparkSession, sf: str) -> DataFrame:
    return mon.prediction_counts(request_log(spark, sf))


@query("confidence_counts", with_sql(LOG_SQL) + " UNION ALL ".join(
    f"SELECT '{lv}' AS \"level\", count(*) FILTER (WHERE confidence = '{lv}') predictions FROM log" for lv in LEVELS))
def confidence_counts(spark: SparkSession, sf: str) -> DataFrame:
    return mon.confidence_counts(request_log(spark, sf))


@query("confidence_counts_zero_fill", with_sql(LOG_SQL) + " UNION ALL ".join(
    f"SELECT '{lv}' AS \"level\", count(*) FILTER (WHERE confidence = '{lv}' AND score > 0.8::DOUBLE) predictions FROM log" for lv in LEVELS))
def confidence_counts_zero_fill(spark: SparkSession, sf: str) -> DataFrame:
    """Levels that never occur are listed with 0."""
    return mon.confidence_counts(request_log(spark, sf).where(F.col("score") > 0.8))


def _buckets_sql(source: str, value: str, bounds, count: str, keys: str = "") -> str:
    lead, group = (f"{keys}, ", f" GROUP BY {keys}") if keys else ("", "")
    rows = [f"SELECT {lead}'{float(b)}' AS le, count(*) FILTER (WHERE {value} <= {float(b)}::DOUBLE) {count} FROM {source}{group}"
            for b in bounds]
    rows.append(f"SELECT {lead}'+Inf' AS le, count({value}) {count} FROM {source}{group}")
    return " UNION ALL ".join(rows)


@query("score_histogram", with_sql(LOG_SQL) + _buckets_sql("log", "score", SCORE_BOUNDS, "cumulative", "handler"))
def score_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return mon.le_histogram(request_log(spark, sf), "score", SCORE_BOUNDS, ["handler"])


@query("histogram_totals", with_sql(LOG_SQL) + """
SELECT handler, round(sum(score), 4) value_sum, count(score) value_count FROM log GROUP BY handler""")
def histogram_totals(spark: SparkSession, sf: str) -> DataFrame:
    return mon.histogram_totals(request_log(spark, sf), "score", ["handler"]).withColumn("value_sum", F.round("value_sum", 4))


@query("bucket_increase", with_sql(_ranged(5 * HOUR, HOUR)) +
       _buckets_sql("ranged", "score", SCORE_BOUNDS, "increase", "window_start"))
def bucket_increase(spark: SparkSession, sf: str) -> DataFrame:
    return mon.bucket_increase(live(spark, sf), "score", SCORE_BOUNDS, "5 hours", "1 hour")


_SIZES_SQL = LOG_SQL.rstrip() + """,
sizes AS (SELECT handler, batch_id, count(*) batch_size, min(ts) ts FROM log GROUP BY handler, batch_id)"""


def batch_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return request_log(spark, sf).groupBy("handler", "batch_id").agg(
        F.count(F.lit(1)).alias("batch_size"), F.min("ts").alias("ts"))


@query("batch_size_histogram", with_sql(_SIZES_SQL) + _buckets_sql("sizes", "batch_size", BATCH_BOUNDS, "cumulative"))
def batch_size_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return mon.le_histogram(batch_sizes(spark, sf), "batch_size", BATCH_BOUNDS)


def _hist_quantile_sql(hist: str, q: float, keys: str, top: float) -> str:
    """The bucket that holds the rank, then a straight line inside it."""
    part = f"PARTITION BY {keys}" if keys else ""
    lead = f"{keys}, " if keys else ""
    return f"""
SELECT {lead}CASE WHEN total = 0 THEN NULL WHEN bound = 'Infinity'::DOUBLE THEN {top}::DOUBLE
     WHEN low IS NULL AND bound <= 0 THEN bound
     ELSE round(coalesce(low, 0) + (bound - coalesce(low, 0)) * ({q}::DOUBLE * total - below) / (cum - below), 6) END AS p{q * 100:g}
FROM (SELECT {lead}bound, cum, max(cum) OVER ({part}) total, coalesce(lag(cum) OVER ({part} ORDER BY bound), 0) below,
             lag(bound) OVER ({part} ORDER BY bound) low
      FROM (SELECT {lead}CASE le WHEN '+Inf' THEN 'Infinity'::DOUBLE ELSE CAST(le AS DOUBLE) END bound, cum FROM ({hist})))
WHERE cum >= {q}::DOUBLE * total QUALIFY row_number() OVER ({part} ORDER BY bound) = 1"""


@query("histogram_quantile", with_sql(LOG_SQL) + _hist_quantile_sql(
    _buckets_sql("log", "score", SCORE_BOUNDS, "cum", "handler"), 0.95, "handler", 1.0))
def histogram_quantile(spark: SparkSession, sf: str) -> DataFrame:
    hist = mon.le_histogram(request_log(spark, sf), "score", SCORE_BOUNDS, ["handler"])
    return mon.histogram_quantile(hist, 0.95, ["handler"]).withColumn("p95", F.round("p95", 6))


_LATENCY_HIST_SQL = _buckets_sql("ranged", "latency_s", LATENCY_BOUNDS, "cum", "window_start")


@query("latency_histogram_quantiles", with_sql(_ranged(5 * HOUR, HOUR) + ", q50 AS (" + _hist_quantile_sql(
    _LATENCY_HIST_SQL, 0.5, "window_start", 60.0) + "), q95 AS (" + _hist_quantile_sql(
    _LATENCY_HIST_SQL, 0.95, "window_start", 60.0) + ")") + "SELECT window_start, p50, p95 FROM q50 JOIN q95 USING (window_start)")
def latency_histogram_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    """Latency quantiles from bucket growth: a fixed number of counters per slot, whatever the traffic."""
    hist = mon.bucket_increase(live(spark, sf), "latency_s", LATENCY_BOUNDS, "5 hours", "1 hour")
    return mon.histogram_quantiles(hist, [0.5, 0.95], ["window_start"], "increase").withColumns({c: F.round(c, 6) for c in ("p50", "p95")})


_SIZE_RANGES = _SIZES_SQL + f", sized AS (SELECT *, {covered_sql(24 * HOUR, 6 * HOUR)} FROM sizes)"


@query("batch_size_quantiles", with_sql(_SIZE_RANGES + """, m50 AS (""" + _hist_quantile_sql(
    _buckets_sql("sized", "batch_size", BATCH_BOUNDS, "cum", "window_start"), 0.5, "window_start", 1000.0) + """), m95 AS (""" +
    _hist_quantile_sql(_buckets_sql("sized", "batch_size", BATCH_BOUNDS, "cum", "window_start"), 0.95, "window_start", 1000.0) + ")")
    + "SELECT window_start, p50, p95 FROM m50 JOIN m95 USING (window_start)")
def batch_size_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    hist = mon.bucket_increase(batch_sizes(spark, sf), "batch_size", BATCH_BOUNDS, "1 day", "6 hours")
    return mon.histogram_quantiles(hist, [0.5, 0.95], ["window_start"], "increase").withColumns({c: F.round(c, 6) for c in ("p50", "p95")})


@query("status_bands", with_sql(_ranged(5 * HOUR, HOUR)) + """
SELECT window_start, CASE WHEN l >= 1.0::DOUBLE THEN 'red' WHEN l >= 0.5::DOUBLE THEN 'yellow' ELSE 'green' END latency_band,
       CASE WHEN e >= 1.0::DOUBLE THEN 'red' WHEN e >= 0.5::DOUBLE THEN 'yellow' ELSE 'green' END error_band
FROM (SELECT window_start, sum(latency_s) / count(*) l, 100 * (count(*) FILTER (WHERE status >= 400))::DOUBLE / count(*) e
      FROM ranged GROUP BY window_start)""")
def status_bands(spark: SparkSession, sf: str) -> DataFrame:
    return mon.service_levels(live(spark, sf), "5 hours", "1 hour").select(
        "window_start", "latency_band", "error_band")


@query("large_batches", with_sql(LOG_SQL) + """
SELECT handler, count(*) batch_size, count(*) BETWEEN 1 AND 1000 accepted FROM log GROUP BY handler""")
def large_batches(spark: SparkSession, sf: str) -> DataFrame:
    """All requests of a handler as one batch: too large at any realistic scale."""
    return v.check_batch_sizes(request_log(spark, sf), "handler")
