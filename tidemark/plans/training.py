"""Fitting, tuning, evaluating, saving and loading classifiers on labelled documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators import importance, registry, runs, scoring, split as sp, training as tr
from tidemark.plans.catalog import query
from tidemark.plans.views import DOCUMENT_SPEC as SPEC, document_features, empty
from tidemark.session import work_dir
from tidemark.sources import models, sinks, tables as src


def _sides(spark: SparkSession, sf: str, label: str = "quality") -> tuple[DataFrame, DataFrame]:
    return sp.split(document_features(spark, sf, label), 0.8, 42, "doc_id")


def _fit(spark: SparkSession, sf: str, algorithm: str, point: int = 0):
    train, test = _sides(spark, sf)
    return tr.fit_once(train, SPEC, tr.algorithms()[algorithm], point), test


def _metrics(spark: SparkSession, sf: str, algorithm: str, point: int = 0) -> DataFrame:
    model, test = _fit(spark, sf, algorithm, point)
    values = tr.evaluate(model, test)
    return spark.createDataFrame([(k, float(v)) for k, v in values.items()], "metric string, value double")


@query("train_lr")
def train_lr(spark: SparkSession, sf: str) -> DataFrame:
    return _metrics(spark, sf, "lr")


@query("train_rf")
def train_rf(spark: SparkSession, sf: str) -> DataFrame:
    return _metrics(spark, sf, "rf")


@query("train_gbt")
def train_gbt(spark: SparkSession, sf: str) -> DataFrame:
    return _metrics(spark, sf, "gbt")


@query("tune_grid")
def tune_grid(spark: SparkSession, sf: str) -> DataFrame:
    """Cross-validated AUC of every grid point of the three algorithms, over the same folds."""
    train, _ = _sides(spark, sf)
    algos = tr.algorithms()
    tuned = tr.tune_many(train, SPEC, algos)
    tables = [tr.tuning_table(spark, algo, tuned[name]) for name, algo in algos.items()]
    return reduce(DataFrame.unionByName, tables)


@query("feature_stages", """
SELECT * FROM (VALUES (0, 'StringIndexer'), (1, 'StringIndexer'), (2, 'OneHotEncoder'), (3, 'VectorAssembler'),
  (4, 'StandardScaler'), (5, 'LogisticRegression')) t(position, stage)""")
def feature_stages(spark: SparkSession, sf: str) -> DataFrame:
    """The fitted stages in order, named after their estimators."""
    model, _ = _fit(spark, sf, "lr")
    names = [type(s).__name__.removesuffix("Model").replace("LogisticRegressionM", "LogisticRegression")
             for s in model.stages]
    return spark.createDataFrame(list(enumerate(names)), "position int, stage string")


@query("positive_score")
def positive_score(spark: SparkSession, sf: str) -> DataFrame:
    """Label, prediction and positive-class probability of the test side."""
    model, test = _fit(spark, sf, "lr")
    return tr.predict(model, test, ["doc_id"])


@query("score_with_model")
def score_with_model(spark: SparkSession, sf: str) -> DataFrame:
    """Every document, labelled or not, scored by the fitted model, with the response columns."""
    model, _ = _fit(spark, sf, "rf")
    return scoring.score_with_model(document_features(spark, sf, None), model, SPEC.numeric, "1", "doc_id").select(
        "doc_id", "churn_prediction", "churn_probability", "confidence", "model_version", "prediction_id")


@query("slot_importance")
def slot_importance(spark: SparkSession, sf: str) -> DataFrame:
    model, _ = _fit(spark, sf, "lr")
    return importance.slot_importance(spark, model)


@query("feature_importance")
def feature_importance(spark: SparkSession, sf: str) -> DataFrame:
    model, _ = _fit(spark, sf, "rf")
    return importance.feature_importance(spark, model)


@query("importance_csv")
def importance_csv(spark: SparkSession, sf: str) -> DataFrame:
    """The importance file read back as text."""
    model, _ = _fit(spark, sf, "gbt")
    path = work_dir(spark, "importance")
    sinks.write_importance(importance.feature_importance(spark, model), path)
    return spark.read.option("header", True).schema("feature string, importance string").csv(path)


_GRID = " | ".join(f"elasticNetParam={e}, regParam={r}" for r in (0.01, 0.1, 0.3) for e in (0.0, 0.5, 1.0))
_TRAIN_ROWS = """
SELECT count(*) FROM documents JOIN labels USING (doc_id)
WHERE ('0x' || substr(md5(CAST(doc_id AS VARCHAR) || '42'), 1, 8))::BIGINT < 0.8 * 4294967296"""


@query("training_params", f"""
SELECT * FROM (VALUES ('algorithm', 'Logistic Regression'), ('num_cv_folds', '3'), ('train_test_split', '80/20'),
  ('feature_count', '8'), ('param_grid_size', '9'), ('param_grid', '{_GRID}')) t("key", "value")
UNION ALL SELECT 'training_rows', CAST(({_TRAIN_ROWS}) AS VARCHAR)""")
def training_params(spark: SparkSession, sf: str) -> DataFrame:
    train, _ = _sides(spark, sf)
    algo = tr.algorithms()["lr"]
    params = tr.training_params(algo.name, algo.grid_points(), SPEC, train.count())
    rows = spark.createDataFrame([("run", k, v) for k, v in params.items()], runs.PARAMS)
    return runs.log_params(rows).select("key", "value")


@query("run_config_json", f"""
SELECT 'Logistic Regression' algorithm, 3 num_cv_folds, '80/20' train_test_split, '{_GRID}' param_grid,
       ({_TRAIN_ROWS})::BIGINT training_rows""")
def run_config_json(spark: SparkSession, sf: str) -> DataFrame:
    """The configuration file of a run read back, its grid as one text."""
    from tidemark.functions.columns import grid_string
    train, _ = _sides(spark, sf)
    algo = tr.algorithms()["lr"]
    path = work_dir(spark, "run-config")
    config = runs.run_config(spark, algo.name, algo.grid_points(), tr.FOLDS, "80/20")
    sinks.write_json(config.withColumn("training_rows", train.agg(F.count(F.lit(1))).scalar()), path)
    back = spark.read.schema(
        "algorithm string, num_cv_folds int, train_test_split string, "
        "param_grid array<map<string,string>>, training_rows bigint").json(path)
    return back.withColumn("param_grid", grid_string("param_grid"))


@query("train_and_compare")
def train_and_compare(spark: SparkSession, sf: str) -> DataFrame:
    """Tune all three algorithms over their whole grids, log their runs to tables, read the tables back
    and compare."""
    train, test = _sides(spark, sf)
    done = tr.train_all(train, test, SPEC)
    path = work_dir(spark, "runs")
    for name, rows in zip(("events", "params", "metrics"), runs.runs_tables(spark, done)):
        sinks.append(rows, f"{path}/{name}")
    wide = runs.run_view(spark.read.parquet(f"{path}/metrics"), spark.read.parquet(f"{path}/params"))
    states = runs.run_states(spark.read.parquet(f"{path}/events")).select("run_id", "status")
    return runs.compare_algorithms(wide).join(states, "run_id").select(
        "algorithm", "auc_roc", "accuracy", "f1_score", "status")


@query("model_save_load", f"""
SELECT 1 AS version, count(*) n, 0::BIGINT AS different FROM documents JOIN labels USING (doc_id)
WHERE ('0x' || substr(md5(CAST(doc_id AS VARCHAR) || '42'), 1, 8))::BIGINT >= 0.8 * 4294967296""")
def model_save_load(spark: SparkSession, sf: str) -> DataFrame:
    """Save a model, register it, promote it, load what is in Production and score with both."""
    model, test = _fit(spark, sf, "lr")
    path = models.save_model(model, work_dir(spark, "model"))
    at = F.timestamp_seconds(F.lit(1704067200))
    auc = tr.evaluate(model, test)["auc_roc"]
    one = spark.createDataFrame([("quality", "run-1", path, "")], "name string, run_id string, source string, description string")
    new = registry.register_versions(one.withColumn("created_at", at), empty(spark, registry.VERSIONS))
    run = spark.createDataFrame([("run-1", float(auc))], "run_id string, auc_roc double")
    events = registry.registration_events(new)
    events = events.unionByName(registry.promote(
        new, events, run, F.timestamp_seconds(F.lit(1704067300)), force=True))
    loaded, version = models.load_stage_model(new, events, "quality")
    mine = tr.predict(model, test, ["doc_id"]).select("doc_id", F.col("score").alias("a"))
    theirs = tr.predict(loaded, test, ["doc_id"]).select("doc_id", F.col("score").alias("b"))
    return mine.join(theirs, "doc_id").agg(
        F.lit(version).alias("version"), F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("a") != F.col("b")).alias("different"))


@query("quality_gate")
def quality_gate(spark: SparkSession, sf: str) -> DataFrame:
    """The same features pass the AUC gate for one label and fail it for another."""
    from tidemark.operators.validate import gate
    rows = []
    for label in ("quality", "toxic"):
        train, test = _sides(spark, sf, label)
        model = tr.fit_once(train, SPEC, tr.algorithms()["lr"])
        rows.append((label, float(tr.evaluate(model, test)["auc_roc"])))
    return gate(spark.createDataFrame(rows, "label string, auc_roc double"), "auc_roc").select("label", "passed")


@query("schema_of_requests")
def schema_of_requests(spark: SparkSession, sf: str) -> DataFrame:
    return src.schema_report(document_features(spark, sf))


@query("training_job")
def training_job(spark: SparkSession, sf: str) -> DataFrame:
    """The whole training job on the documents: profile, tune all algorithms, log, register, gate, promote."""
    from tidemark import jobs
    root = work_dir(spark, "registry")
    jobs.training_job(document_features(spark, sf), SPEC, root, "document-quality")
    return jobs.serving(spark, root).select("name", "version", "stage", "algorithm", "description")
