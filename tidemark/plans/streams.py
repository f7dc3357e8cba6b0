"""The streaming jobs, replayed over a folder of files and read back from their tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.operators import monitor as mon
from tidemark.plans.catalog import query
from tidemark.plans.monitoring import HOUR, _buckets_sql
from tidemark.plans.tables import REQUESTS_SQL, _batches
from tidemark.plans.views import LOG_SQL, covered_sql, field_errors_sql, scored_sql, shape_log, table, with_sql
from tidemark.session import work_dir
from tidemark.sources import sinks, tables as src
from tidemark.spec import CUSTOMER_FIELDS, SCORE_BOUNDS, request_schema
from tidemark.streaming import live

BATCH_SCHEMA = T.StructType([
    T.StructField("batch_id", T.StringType()),
    T.StructField("customers", T.ArrayType(request_schema(text=True))),
])

_NUMBERS = ", ".join(
    f"TRY_CAST(\"{f.name}\" AS {'INTEGER' if f.type == 'int' else 'DOUBLE'}) AS \"{f.name}\""
    for f in CUSTOMER_FIELDS if f.type != "string")


@query("stream_scores", with_sql(REQUESTS_SQL.rstrip() + f""",
checked AS (SELECT *, list_filter({field_errors_sql(True)}, lambda x: x IS NOT NULL) errors FROM requests),
arrived AS (SELECT * REPLACE ({_NUMBERS}), CASE WHEN len(errors) = 0 THEN 'valid' ELSE 'invalid' END status,
                   (row_number() OVER (PARTITION BY batch_id ORDER BY custkey) - 1)::INTEGER AS "position" FROM checked),"""
    + scored_sql("arrived", "answers", "batch_id")) + """
SELECT batch_id, "position", status, churn_prediction, churn_probability, confidence,
       md5(batch_id || ':' || CAST("position" AS VARCHAR)) prediction_id FROM answers""")
def stream_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Request files are scored as they arrive; the answers form an append-only table."""
    arriving, out, mark = (work_dir(spark, n) for n in ("arriving", "answers", "answers-checkpoint"))
    sinks.write_json(_batches(spark, sf), arriving)
    requests = src.explode_batch(live.read_stream(spark, arriving, BATCH_SCHEMA, "json"))
    requests = requests.withColumn("request", F.concat_ws(":", "batch_id", F.col("position").cast("string")))
    answers = live.score_stream(requests, version="1", key="request").select(
        "batch_id", "position", "status", "churn_prediction", "churn_probability", "confidence", "prediction_id")
    live.append_to(answers, out, mark).awaitTermination()
    return spark.read.schema(answers.schema).parquet(out)


def _log_stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = table(spark, sf, "events").schema
    return shape_log(live.read_stream(spark, sf, schema, name_pattern="events.parquet"))


def _replay(spark: SparkSession, updates: DataFrame, keys: list[str], name: str) -> DataFrame:
    out, mark = work_dir(spark, name), work_dir(spark, f"{name}-checkpoint")
    live.update_to(updates, out, mark).awaitTermination()
    return live.latest(spark.read.parquet(out), keys)


@query("stream_counts", with_sql(LOG_SQL) + """
SELECT churn_prediction, confidence, count(*) n FROM log GROUP BY ALL""")
def stream_counts(spark: SparkSession, sf: str) -> DataFrame:
    keys = ["churn_prediction", "confidence"]
    return _replay(spark, live.stream_counts(_log_stream(spark, sf), keys), keys, "counts")


@query("stream_rate", with_sql(LOG_SQL.rstrip() + f", ranged AS (SELECT *, {covered_sql(5 * HOUR, HOUR)} FROM log)") + """
SELECT window_start, handler, count(*) n, count(*) / 18000.0::DOUBLE per_second FROM ranged GROUP BY ALL""")
def stream_rate(spark: SparkSession, sf: str) -> DataFrame:
    """Panes on the stream, ranges when they are read."""
    panes = live.stream_panes(_log_stream(spark, sf), ["handler"], "1 hour", "1 hour")
    now = _replay(spark, panes, ["__slot", "handler"], "panes")
    out = live.ranges_of_panes(now, "5 hours", "1 hour", ["handler"])
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("stream_histogram", with_sql(LOG_SQL) + _buckets_sql("log", "score", SCORE_BOUNDS, "cumulative", "handler"))
def stream_histogram(spark: SparkSession, sf: str) -> DataFrame:
    """The batch histogram operator on a stream."""
    updates = mon.le_histogram(_log_stream(spark, sf), "score", SCORE_BOUNDS, ["handler"])
    return _replay(spark, updates, ["handler", "le"], "histogram")


def _latency_panes(spark: SparkSession, sf: str) -> DataFrame:
    panes = live.stream_panes(_log_stream(spark, sf), [], "1 hour", "1 hour", "ts", "latency_s")
    return _replay(spark, panes, ["__slot"], "latency")


@query("stream_latency")
def stream_latency(spark: SparkSession, sf: str) -> DataFrame:
    """Approximate latency quantiles: a sketch is the state of a pane, ranges merge sketches."""
    return live.ranges_of_panes(_latency_panes(spark, sf), "5 hours", "1 hour", (), (0.5, 0.95))


@query("stream_latency_ranks", with_sql(LOG_SQL.rstrip() + f", ranged AS (SELECT *, {covered_sql(5 * HOUR, HOUR)} FROM log)") + """
SELECT window_start, count(*) n, true p50_close, true p95_close FROM ranged WHERE latency_s IS NOT NULL GROUP BY window_start""")
def stream_latency_ranks(spark: SparkSession, sf: str) -> DataFrame:
    """Whether the streamed quantiles lie within three percent of the rows of the rank they stand for."""
    found = live.ranges_of_panes(_latency_panes(spark, sf), "5 hours", "1 hour", (), (0.5, 0.95))
    log = shape_log(table(spark, sf, "events")).where("latency_s IS NOT NULL")
    ranged = mon.cover(log.select(F.window("ts", "1 hour").start.alias("__slot"), "latency_s"), "5 hours", "1 hour")

    def close(q: float, name: str):
        under, upto = F.count_if(F.col("latency_s") < F.col(name)), F.count_if(F.col("latency_s") <= F.col(name))
        n = F.count(F.lit(1))
        return (under / n <= q + 0.03) & (upto / n >= q - 0.03)

    return (ranged.withColumn("window_start", F.col("window_start").cast("timestamp"))
            .join(found.select("window_start", "p50", "p95"), "window_start").groupBy("window_start")
            .agg(F.count(F.lit(1)).alias("n"), close(0.5, "p50").alias("p50_close"), close(0.95, "p95").alias("p95_close"))
            .withColumn("window_start", F.col("window_start").cast("timestamp_ntz")))


@query("stream_snapshots", with_sql(LOG_SQL) + """
SELECT handler, confidence, count(*) n FROM log GROUP BY ALL""")
def stream_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Running counters over batches of a few files, with a snapshot after every second batch."""
    keys, spread = ["handler", "confidence"], work_dir(spark, "log-files")
    log = table(spark, sf, "events")
    log.repartition(6, "event_id" if "event_id" in log.columns else log.columns[0]).write.parquet(spread)
    arriving = shape_log(live.read_stream(spark, spread, log.schema, files_per_batch=1))
    counts = live.stream_counts(arriving, keys)
    out = work_dir(spark, "snapshots")
    live.snapshot_to(counts, out, work_dir(spark, "snapshots-checkpoint"), keys, every=2).awaitTermination()
    return live.read_latest(spark, out, counts.schema, keys)
