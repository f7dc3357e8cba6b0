"""Experiments and runs as append-only tables.

experiments(name, experiment_id) · run_events(run_id, experiment_id, status, at, reason)
run_params(run_id, key, value) · run_metrics(run_id, key, value)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.columns import fixed
from tidemark.operators.training import Recorder, TrainedRun
from tidemark.sources.sinks import append_shared
from tidemark.spec import RUN_METRICS, RUN_PARAMS

RUN_EVENTS = "run_id string, experiment_id string, status string, at timestamp, reason string"
PARAMS = "run_id string, key string, value string"
METRICS = "run_id string, key string, value double"


def experiment_id(name: Column) -> Column:
    return F.md5(name)


def ensure_experiments(existing: DataFrame, names: DataFrame, name: str = "name") -> DataFrame:
    """The rows to append for experiment names not yet present; asking twice adds nothing."""
    wanted = names.select(F.col(name).alias("name")).where(F.col("name").isNotNull()).distinct()
    return (wanted.join(existing.select("name"), "name", "left_anti")
            .withColumn("experiment_id", experiment_id(F.col("name"))))


def log_params(params: DataFrame) -> DataFrame:
    """Parameter rows as stored: whole text values, so that a long grid can be read back."""
    return params.select("run_id", "key", F.col("value").cast("string").alias("value"))


def log_metrics(wide: DataFrame, run_id: str = "run_id", names: Sequence[str] = RUN_METRICS) -> DataFrame:
    """One row per run and metric from one column per metric; missing metrics add no row."""
    pairs = F.array(*[F.struct(F.lit(n).alias("key"), F.col(n).cast("double").alias("value")) for n in names])
    return (wide.select(F.col(run_id).alias("run_id"), F.inline(pairs))
            .where(F.col("value").isNotNull()))


def log_run(runs: DataFrame, status: str, at: Column | str, reason: Column | str | None = None) -> DataFrame:
    """Event rows that start or end runs; ``reason`` says why a run failed."""
    when = F.col(at) if isinstance(at, str) else at
    why = F.col(reason) if isinstance(reason, str) else F.lit(None) if reason is None else reason
    return runs.select("run_id", "experiment_id", F.lit(status).alias("status"),
                       when.cast("timestamp").alias("at"), why.cast("string").alias("reason"))


def run_states(events: DataFrame) -> DataFrame:
    """Latest status of each run, its start and (when it has ended) end time and duration."""
    ended = F.max(F.when(F.col("status") != "RUNNING", F.col("at")))
    started = F.min(F.when(F.col("status") == "RUNNING", F.col("at")))
    return (events.groupBy("run_id", "experiment_id")
            .agg(F.max_by("status", F.struct("at", F.col("status") != "RUNNING")).alias("status"),
                 started.alias("started_at"), ended.alias("ended_at"))
            .withColumn("duration_seconds", F.round(
                (F.unix_micros("ended_at") - F.unix_micros("started_at")) / 1_000_000, 3)))


def run_failures(events: DataFrame) -> DataFrame:
    """The runs whose latest status is FAILED: when they began and ended, and the reason given last."""
    last = F.max_by(F.struct("status", "reason"), F.struct("at", F.col("status") != "RUNNING"))
    return (events.groupBy("run_id", "experiment_id").agg(
        last.alias("last"), F.min("at").alias("started_at"), F.max("at").alias("failed_at"))
        .where("last.status = 'FAILED'").select("run_id", "experiment_id", "started_at", "failed_at", "last.reason"))


def abandoned(events: DataFrame, before: Column) -> DataFrame:
    """FAILED events for runs that began before a time and never ended: the job that had them is gone."""
    open_ = run_states(events).where((F.col("status") == "RUNNING") & (F.col("started_at") < before))
    return log_run(open_, "FAILED", before, F.lit("abandoned"))


def _pivot(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """Fixed key list, so one aggregate without a pass to find the keys."""
    return rows.groupBy("run_id").agg(*[
        F.max(F.when(F.col("key") == n, F.col("value"))).alias(n) for n in names])


def run_view(run_metrics: DataFrame, run_params: DataFrame | None = None,
             metrics: Sequence[str] = RUN_METRICS, params: Sequence[str] = RUN_PARAMS) -> DataFrame:
    """One row per run with its metrics and parameters as columns."""
    wide = _pivot(run_metrics, metrics)
    return wide if run_params is None else wide.join(_pivot(run_params, params), "run_id", "left")


def union_runs(*tables: DataFrame) -> DataFrame:
    """Results of several trainings in one table; columns are matched by name."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def compare_algorithms(runs: DataFrame) -> DataFrame:
    """AUC, accuracy, F1 (four decimals) and seconds (one decimal), best first."""
    return runs.select(
        "run_id", "algorithm", *[F.round(c, 4).alias(c) for c in ("auc_roc", "accuracy", "f1_score")],
        F.round("training_duration_seconds", 1).alias("seconds"),
    ).orderBy(F.col("auc_roc").desc(), "run_id")


def champion(runs: DataFrame, by: Sequence[str] = (), metric: str = "auc_roc",
             logged: str = "logged_order") -> DataFrame:
    """The run with the highest metric; the one logged first wins a tie. Each task keeps only
    its best row, so a model with very many runs is no problem."""
    others = [c for c in runs.columns if c not in by]
    best = F.max_by(F.struct(*others), F.struct(F.col(metric), -F.col(logged)))
    return (runs.where(F.col(metric).isNotNull()).groupBy(*by).agg(best.alias("__best"))
            .select(*by, "__best.*"))


def describe_run(algorithm: Column, auc: Column, accuracy: Column, f1: Column, seconds: Column) -> Column:
    """Description text of a registered version."""
    return F.concat_ws(
        "; ", F.concat(F.lit("best run by AUC, "), algorithm),
        F.concat(F.lit("auc "), fixed(auc, 4)), F.concat(F.lit("accuracy "), fixed(accuracy, 4)),
        F.concat(F.lit("f1 "), fixed(f1, 4)), F.concat(F.lit("fitted in "), fixed(seconds, 1), F.lit(" seconds")))


def model_summary(runs: DataFrame, stages: int) -> DataFrame:
    """Summary rows written next to a run."""
    return runs.select(
        "algorithm", "run_id", "auc_roc", "accuracy", "f1_score",
        F.col("training_duration_seconds").alias("training_seconds"), F.lit(stages).alias("pipeline_stages"))


def run_config(spark: SparkSession, algorithm: str, grid: Sequence[dict[str, str]], folds: int,
               split_text: str) -> DataFrame:
    """Configuration row of a run: algorithm, folds, split and the grid as a list of maps."""
    return spark.createDataFrame(
        [(algorithm, folds, split_text, list(grid))],
        "algorithm string, num_cv_folds int, train_test_split string, param_grid array<map<string,string>>")


def _moment(seconds: str) -> Column:
    return F.timestamp_micros((F.col(seconds) * 1_000_000).cast("bigint"))


def runs_tables(spark: SparkSession, runs: Sequence[TrainedRun]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(run_events, run_params, run_metrics) rows of finished trainings, ready to append."""
    events, params, metrics = [], [], []
    for r in runs:
        events += [(r.run_id, r.experiment, "RUNNING", r.started), (r.run_id, r.experiment, "FINISHED", r.ended)]
        params += [(r.run_id, k, v) for k, v in r.params.items()]
        metrics += [(r.run_id, k, float(v)) for k, v in r.metrics.items()]
    ev = spark.createDataFrame(events, "run_id string, experiment string, status string, at double").select(
        "run_id", experiment_id(F.col("experiment")).alias("experiment_id"), "status", _moment("at").alias("at"),
        F.lit(None).cast("string").alias("reason"))
    return ev, log_params(spark.createDataFrame(params, PARAMS)), spark.createDataFrame(metrics, METRICS)


class RunLog(Recorder):
    """Writes each run into the tables under ``root`` while it exists: RUNNING and the parameters before its first
    fit, the metrics and FINISHED when it is done, FAILED and the reason when it raised. Rows are only added."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _event(self, run_id: str, experiment: str, status: str, at: float, reason: str | None = None) -> None:
        row = self.spark.createDataFrame([(run_id, experiment, at, reason)],
                                         "run_id string, experiment string, at double, reason string")
        row = row.withColumn("experiment_id", experiment_id(F.col("experiment")))
        append_shared(log_run(row, status, _moment("at"), "reason").coalesce(1), f"{self.root}/run_events")

    def started(self, run_id, algorithm, params, at) -> None:
        self._event(run_id, algorithm.experiment, "RUNNING", at)
        rows = self.spark.createDataFrame([(run_id, k, v) for k, v in params.items()], PARAMS)
        append_shared(log_params(rows).coalesce(1), f"{self.root}/run_params")

    def finished(self, run) -> None:
        rows = self.spark.createDataFrame([(run.run_id, k, float(v)) for k, v in run.metrics.items()], METRICS)
        append_shared(rows.coalesce(1), f"{self.root}/run_metrics")
        self._event(run.run_id, run.experiment, "FINISHED", run.ended)

    def failed(self, run_id, algorithm, reason, at) -> None:
        self._event(run_id, algorithm.experiment, "FAILED", at, reason)
