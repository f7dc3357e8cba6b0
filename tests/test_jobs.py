"""The whole jobs over one registry folder."""

import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tests.test_clean_validate import request
from tidemark import jobs
from tidemark.operators import training as tr
from tidemark.plans.views import customers
from tidemark.sources import sinks
from tidemark.spec import CUSTOMER


@pytest.fixture(scope="module")
def rows(spark, sf):
    """Customers with a label that follows from their charges, so that the gate can be passed."""
    base = customers(spark, sf).where("TotalCharges IS NOT NULL")
    middle = base.agg(F.percentile("MonthlyCharges", 0.5)).scalar()
    return base.withColumn("Churn", F.when(F.col("MonthlyCharges") > middle, "Yes").otherwise("No"))


def one_point(*names):
    return {k: tr.Algorithm(a.name, a.experiment, a.classifier, a.grid[:1])
            for k, a in tr.algorithms(max_iter=30).items() if k in names}


def test_train_register_promote_score_roll_back(spark, rows, valid_row, tmp_path):
    root = str(tmp_path)
    new = request(spark, valid_row, {**valid_row, "tenure": -1}, {**valid_row, "PaymentMethod": "Cash"})

    rules = jobs.score_customers(new, root, "churn").collect()
    assert sorted(str(r["churn_probability"]) for r in rules) == ["0.44", "None", "None"]

    decision = jobs.training_job(rows, CUSTOMER, root, "churn", one_point("lr", "rf"), folds=2).first()
    assert decision["passed"] and decision["version"] == 1
    info = jobs.serving(spark, root).first()
    assert info["version"] == 1 and info["tags"]["framework"] == "spark_mllib"
    assert set(info["training_metrics"]) >= {"auc_roc", "f1_score"}

    scored = jobs.score_customers(new, root, "churn").collect()
    assert len(scored) == 3 and {r["model_version"] for r in scored} == {"1"}
    assert sum(r["churn_probability"] is not None for r in scored) == 1
    assert spark.read.parquet(f"{root}/predictions").count() == 6

    report, shift = jobs.drift_job(new, root, "churn")
    assert {r["measure"] for r in report.collect()} == {"churn_rate_pct", "avg_probability"}
    assert shift.where("bucket = '+Inf' AND baseline_share = 1 AND shifted_share = 1").count() == 1

    run = jobs.stored(spark, root, "versions").first()["run_id"]
    assert "feature,importance" in [r[0] for r in spark.read.text(f"{root}/artifacts/{run}/feature_importance").collect()]
    assert spark.read.parquet(f"{root}/artifacts/{run}/roc_curve").where("series = 'random'").count() == 2
    assert spark.read.json(f"{root}/artifacts/{run}/run_config").first()["num_cv_folds"] == 2

    best = jobs.run_table(spark, root).where(F.col("run_id") == run)
    jobs.register(spark, root, "churn", best)
    jobs.promote(spark, root, "churn", threshold=1.1)
    assert jobs.serving(spark, root).first()["version"] == 1
    jobs.promote(spark, root, "churn", version=2, force=True)
    assert [r["version"] for r in jobs.serving(spark, root).collect()] == [2]
    table, verdict = jobs.compare(spark, root, "churn", 1, 2)
    assert {r["winner"] for r in table.collect()} == {"tie"} and verdict.first()["winner_version"] is None
    jobs.roll_back(spark, root, "churn")
    assert [r["version"] for r in jobs.serving(spark, root).collect()] == [1]


def test_large_batches_are_rejected_as_a_whole(spark, valid_row, tmp_path):
    """1,001 rows are too many, 1,000 are not; rows without a batch have no limit; other errors stay first."""
    one = request(spark, valid_row)
    many = one.crossJoin(spark.range(1001).select(F.lit("large").alias("batch"), F.col("id").alias("n")))
    fits = one.crossJoin(spark.range(1000).select(F.lit("fits").alias("batch"), F.col("id").alias("n")))
    free = one.crossJoin(spark.range(1001).select(F.lit(None).cast("string").alias("batch"), F.col("id").alias("n")))
    rows = many.withColumn("tenure", F.when(F.col("n") == 0, -1).otherwise(F.col("tenure"))).unionByName(fits).unionByName(free)
    out = jobs.score_customers(rows, str(tmp_path), "churn", batch="batch")
    got = {(r["batch"], r["status"]): (r["n"], r["scored"]) for r in out.groupBy("batch", "status").agg(
        F.count(F.lit(1)).alias("n"), F.count("churn_probability").alias("scored")).collect()}
    assert got == {("large", "invalid"): (1001, 0), ("fits", "valid"): (1000, 1000), (None, "valid"): (1001, 1001)}
    details = {r["detail"] for r in out.where("batch = 'large'").select("detail").collect()}
    over = "batch: 1001 rows, at most 1000 allowed"
    assert details == {over, f"tenure: Input should be greater than or equal to 0; {over}"}


def test_rare_categories_in_the_training_job(spark, rows, tmp_path):
    root = str(tmp_path)
    jobs.training_job(rows, CUSTOMER, root, "churn", one_point("lr"), folds=2, max_categories=3)
    loss = {r["column_name"]: r for r in spark.read.parquet(f"{root}/category_loss").collect()}
    assert set(loss) == set(CUSTOMER.categorical)
    assert loss["gender"]["rows_lost"] == 0 and loss["gender"]["kept_values"] == 2
    assert loss["PaymentMethod"]["kept_values"] <= 3


def test_eight_writers_register_at_once(spark, tmp_path):
    """Each gets a version number of its own, with its tags and events; the model is listed once."""
    root = str(tmp_path)
    best = spark.createDataFrame([("r", "LogisticRegression", 0.9, 0.8, 0.7, 1.0)], "run_id string, algorithm string, "
                                 "auc_roc double, accuracy double, f1_score double, training_duration_seconds double")
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda k: jobs.register(spark, root, "a/model", best.withColumn("run_id", F.lit(f"run{k}")), {"by": str(k)}),
                      range(8)))
    versions = jobs.stored(spark, root, "versions").collect()
    assert sorted(r["version"] for r in versions) == list(range(1, 9))
    assert {r["run_id"] for r in versions} == {f"run{k}" for k in range(8)}
    assert [r["name"] for r in jobs.stored(spark, root, "models").collect()] == ["a/model"]
    by = {r["version"]: r["value"] for r in jobs.stored(spark, root, "tags").where("key = 'by'").collect()}
    assert by == {r["version"]: r["run_id"][3:] for r in versions}
    assert jobs.stored(spark, root, "stage_events").groupBy("version").count().where("count = 2").count() == 8


def test_a_claim_is_given_once(spark, tmp_path):
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda k: sinks.claim(spark, f"{tmp_path}/claims/{k % 50}"), range(400)))
    assert sum(got) == 50
    assert jobs.claim_version(spark, str(tmp_path), "m") == 1 and jobs.claim_version(spark, str(tmp_path), "m") == 2


def test_registering_no_run_claims_nothing(spark, tmp_path):
    none = spark.createDataFrame([], "run_id string, algorithm string, auc_roc double, accuracy double, f1_score double, "
                                     "training_duration_seconds double")
    jobs.register(spark, str(tmp_path), "m", none)
    assert jobs.stored(spark, str(tmp_path), "versions").isEmpty() and jobs.claim_version(spark, str(tmp_path), "m") == 1


def test_the_training_job_makes_its_rows_once(spark, rows, tmp_path):
    """Rows can be costly to make (features of whole texts): profile, split, fits and artifacts share one pass over them."""
    made = spark.sparkContext.accumulator(0)
    known = rows.limit(300).collect()

    def count(row):
        made.add(1)
        return row

    costly = spark.createDataFrame(spark.sparkContext.parallelize(known, 2).map(count), rows.schema)
    jobs.training_job(costly, CUSTOMER, str(tmp_path), "churn", one_point("lr"), folds=2)
    assert made.value == len(known)
