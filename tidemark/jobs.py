"""The whole jobs: train and register, score requests, promote, compare, report drift.

All state lives in tables under one root folder that every executor can reach:
``experiments run_events run_params run_metrics fits models versions stage_events tags
predictions`` and, per run, ``artifacts/<run_id>/``.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators import drift, features, importance, registry as reg, runs, scoring, training as tr
from tidemark.operators.journal import FitJournal
from tidemark.operators.metrics import confusion_matrix, roc_curve
from tidemark.operators.profile import exploration_summary
from tidemark.operators.split import cached, split
from tidemark.operators.validate import typed, validate, with_batch_limit
from tidemark.sources import models, sinks
from tidemark.spec import CUSTOMER_FIELDS, GATE_THRESHOLD, MAX_BATCH, FeatureSpec

SCHEMAS = {
    "experiments": "name string, experiment_id string", "run_events": runs.RUN_EVENTS, "run_params": runs.PARAMS,
    "run_metrics": runs.METRICS, "models": "name string", "versions": reg.VERSIONS,
    "stage_events": reg.STAGE_EVENTS, "tags": reg.TAGS,
}


def stored(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A registry table; empty while nothing has been written to it."""
    rows = sinks.read_shared(spark, f"{root}/{table}", SCHEMAS[table])
    return rows.distinct() if table in ("experiments", "models") else rows  # two writers may have added one name


def _now():
    return F.current_timestamp()


def write_artifacts(spark: SparkSession, run: tr.TrainedRun, spec: FeatureSpec, test: DataFrame,
                    grid: list[dict[str, str]], path: str) -> None:
    """Importance CSV, configuration and summary JSON, confusion matrix and ROC tables, model."""
    models.save_model(run.model, f"{path}/model")
    sinks.write_importance(importance.feature_importance(spark, run.model), f"{path}/feature_importance")
    sinks.write_json(runs.run_config(spark, run.algorithm, grid, int(run.params["num_cv_folds"]),
                                     run.params["train_test_split"]), f"{path}/run_config")
    row = [(run.algorithm, run.run_id, *[float(run.metrics[m]) for m in (
        "auc_roc", "accuracy", "f1_score", "training_duration_seconds")])]
    wide = spark.createDataFrame(row, "algorithm string, run_id string, auc_roc double, accuracy double, "
                                      "f1_score double, training_duration_seconds double")
    sinks.write_json(runs.model_summary(wide, len(run.model.stages)), f"{path}/model_summary")
    with cached(tr.predict(run.model, test)) as (pred,):
        sinks.append(confusion_matrix(pred), f"{path}/confusion_matrix")
        sinks.append(roc_curve(pred, "score", "label", baseline=True), f"{path}/roc_curve")


def training_job(rows: DataFrame, spec: FeatureSpec, root: str, name: str,
                 algos: Mapping[str, tr.Algorithm] | None = None, threshold: float = GATE_THRESHOLD,
                 folds: int = tr.FOLDS, tags: Mapping[str, str] | None = None, partitions: int | None = None,
                 max_categories: int | None = None) -> DataFrame:
    """Profile, split, tune every algorithm, log the runs, register the champion, promote it if it
    passes the gate. ``rows`` are cleaned and carry ``spec.key``. Rows that no fit can use, for want of a
    number or the label, are written to the ``quarantine`` table. Returns the promotion decision. With ``max_categories``
    text columns of more values keep only their frequent ones (``features.kept_categories``), counted on the training
    side; the rows that lose a value are in the ``category_loss`` table, and at scoring such values count as unseen.

    Runs are in the tables while they run (``runs.RunLog``) and every finished fit is in ``fits``: a job that died
    and is started again with the same rows fits only what is missing."""
    spark = rows.sparkSession
    with cached(rows) as (rows,):  # features of whole texts cost more than a fit: they are made once
        known = tr.usable(spec) & F.col(spec.label).isNotNull()
        reason = F.when(F.col(spec.label).isNull(), F.lit("no label")).otherwise("a number is missing")
        sinks.append(rows.where(~known).select(F.col(spec.key).cast("string").alias("key"), reason.alias("reason")),
                     f"{root}/quarantine")
        rows = rows.where(known)
        algos = tr.algorithms() if algos is None else algos
        sinks.write_exploration(exploration_summary(rows.drop(spec.key), spec), f"{root}/exploration")

        train, test = split(rows, key=spec.key)
        if max_categories and spec.categorical:
            kept = sinks.materialize(features.kept_categories(train, spec.categorical, max_categories), "kept-categories")
            sinks.append(features.category_loss(train, kept, spec.categorical), f"{root}/category_loss")
            train = features.keep_categories(train, kept, spec.categorical)
        wanted = spark.createDataFrame([(a.experiment,) for a in algos.values()], "name string")
        sinks.append_shared(runs.ensure_experiments(stored(spark, root, "experiments"), wanted), f"{root}/experiments")
        done = tr.train_all(train, test, spec, algos, folds, partitions=partitions,
                            journal=FitJournal(spark, f"{root}/fits"), recorder=runs.RunLog(spark, root))
        grids = {a.name: a.grid_points() for a in algos.values()}
        for run in done:
            write_artifacts(spark, run, spec, test, grids[run.algorithm], f"{root}/artifacts/{run.run_id}")

    order = spark.createDataFrame([(r.run_id, i) for i, r in enumerate(done)], "run_id string, logged_order int")
    best = runs.champion(run_table(spark, root).join(order, "run_id"))
    register(spark, root, name, best, tags)
    return promote(spark, root, name, threshold)


def run_table(spark: SparkSession, root: str) -> DataFrame:
    return runs.run_view(stored(spark, root, "run_metrics"), stored(spark, root, "run_params"))


def claim_version(spark: SparkSession, root: str, name: str) -> int:
    """The next version number of a model, for this caller alone: whoever creates the number's marker file has it, others
    go on to the next one. A job that dies between claim and registration leaves a gap."""
    last = stored(spark, root, "versions").where(F.col("name") == name).agg(F.max("version")).first()[0] or 0
    folder = f"{root}/claims/{hashlib.md5(name.encode()).hexdigest()}"
    while True:
        last += 1
        if sinks.claim(spark, f"{folder}/{last}"):
            return last


def register(spark: SparkSession, root: str, name: str, best: DataFrame, tags: Mapping[str, str] | None = None) -> None:
    """Register one run as the next version of a model: description, tags (also the caller's), stage Staging.
    Several jobs may do so at once. ``best`` holds one run; none registers nothing."""
    best = sinks.materialize(best, "champion")
    if best.isEmpty():
        return
    metrics = [F.col(c) for c in ("algorithm", "auc_roc", "accuracy", "f1_score", "training_duration_seconds")]
    named = best.withColumn("name", F.lit(name))
    sinks.append_shared(reg.ensure_models(stored(spark, root, "models"), named), f"{root}/models")
    candidate = named.select("name", "run_id", F.concat(F.lit(f"{root}/artifacts/"), "run_id", F.lit("/model")).alias("source"),
                             runs.describe_run(*metrics).alias("description"), _now().alias("created_at"))
    number = claim_version(spark, root, name)
    version = sinks.materialize(candidate.withColumn("version", F.lit(number)).select(*stored(spark, root, "versions").columns),
                                "new-version")
    sinks.append_shared(version, f"{root}/versions")
    sinks.append_shared(reg.registration_events(version), f"{root}/stage_events")
    tagged = version.join(best.select("run_id", "algorithm", "auc_roc"), "run_id")
    own = {k: F.lit(v) for k, v in (tags or {}).items()}
    sinks.append_shared(reg.tag_versions(tagged, {**reg.standard_tags(F.col("algorithm"), F.col("auc_roc")), **own}), f"{root}/tags")


def _target(spark: SparkSession, name: str, version: int | None) -> DataFrame | None:
    return None if version is None else spark.createDataFrame([(name, version)], "name string, version int")


def promote(spark: SparkSession, root: str, name: str, threshold: float = GATE_THRESHOLD,
            version: int | None = None, force: bool = False) -> DataFrame:
    """Move the latest staged version (or a given one) to Production if it passes the gate."""
    mine = F.col("name") == name
    versions, events = stored(spark, root, "versions").where(mine), stored(spark, root, "stage_events").where(mine)
    table, target = run_table(spark, root), _target(spark, name, version)
    decision = sinks.materialize(
        reg.promotion_decisions(versions, events, table, threshold, force, target), "decision")
    sinks.append_shared(reg.promote(versions, events, table, _now(), threshold, force, target), f"{root}/stage_events")
    return decision


def roll_back(spark: SparkSession, root: str, name: str, version: int | None = None) -> None:
    """Put the previous (or a given) version back into Production."""
    events = stored(spark, root, "stage_events").where(F.col("name") == name)
    sinks.append_shared(reg.rollback(events, _now(), _target(spark, name, version)), f"{root}/stage_events")


def compare(spark: SparkSession, root: str, name: str, v1: int, v2: int,
            missing: str = "no_vote") -> tuple[DataFrame, DataFrame]:
    """Metric by metric comparison of two versions, and the verdict."""
    mine = F.col("name") == name
    metrics = reg.version_metrics(stored(spark, root, "versions").where(mine), run_table(spark, root))
    table = reg.compare_versions(metrics, v1, v2, missing)
    return table, reg.comparison_verdict(table, v1, v2, reg.current_stages(stored(spark, root, "stage_events").where(mine)))


def serving(spark: SparkSession, root: str, stage: str = "Production") -> DataFrame:
    """Model information rows of everything in a stage."""
    return reg.model_info(stored(spark, root, "versions"), stored(spark, root, "stage_events"),
                          run_table(spark, root), stored(spark, root, "tags"), stage)


def _answers(rows: DataFrame, root: str, name: str, key: str | None = None) -> DataFrame:
    """Checked rows scored with the Production model, or with the rules while there is none."""
    spark = rows.sparkSession
    found = models.load_stage_model(stored(spark, root, "versions"), stored(spark, root, "stage_events"), name)
    if found is None:
        return scoring.score_batch(rows, version=None, key=key)
    numeric = [f.name for f in CUSTOMER_FIELDS if f.type != "string"]
    return scoring.score_with_model(rows, found[0], numeric, str(found[1]), key)


def drift_job(requests: DataFrame, root: str, name: str) -> tuple[DataFrame, DataFrame]:
    """Score the valid requests as they are and as the shifted cohort: the drift report, and the change of
    the score distribution. The answers are written once, and both reports read them."""
    rows = typed(validate(requests, CUSTOMER_FIELDS), CUSTOMER_FIELDS).where(F.col("status") == "valid")
    scored = sinks.materialize(_answers(drift.with_shifted(rows), root, name).select(
        "cohort", "churn_prediction", "churn_probability", "confidence"), "drift")
    return drift.drift_report(scored), drift.distribution_shift(scored)


def score_customers(requests: DataFrame, root: str, name: str, key: str | None = None,
                    log: bool = True, batch: str | None = None, max_batch: int = MAX_BATCH) -> DataFrame:
    """Validate request rows and score them with the Production model, or with the rules while
    there is none. Every row is answered; answers are appended to the prediction log, by date, and the
    rows returned are the logged ones. With ``batch``, the column that names a row's batch, batches of more than
    ``max_batch`` rows are rejected as a whole: their rows get no score and the reason."""
    spark = requests.sparkSession
    checked = validate(requests, CUSTOMER_FIELDS)
    if batch:
        checked = with_batch_limit(checked, batch, max_batch)
    out = _answers(typed(checked, CUSTOMER_FIELDS), root, name, key)
    if not log:
        return out
    job = uuid.uuid4().hex
    path = f"{root}/predictions"
    logged = out.withColumns({"ts": _now(), "job_id": F.lit(job)}).withColumn("date", F.to_date("ts"))
    sinks.append(logged, path, ("date",))
    return spark.read.schema(logged.schema).parquet(path).where(F.col("job_id") == job)
