"""Rule score, bands, ids, drift, metrics."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tests.test_clean_validate import request
from tidemark.functions.columns import clamp, confidence_level, elapsed_ms, elapsed_seconds, grid_string, round_score
from tidemark.operators import drift, metrics as m, scoring as s, validate as v
from tidemark.operators.running import number_rows
from tidemark.spec import CUSTOMER_FIELDS


def test_score_of_the_sample_row(spark, valid_row):
    row = s.score_batch(v.validate(request(spark, valid_row)), version="7").first()
    assert (row["churn_probability"], row["churn_prediction"], row["confidence"], row["model_version"]) == (
        0.44, False, "low", "7")


def test_every_input_row_gets_one_answer(spark, valid_row):
    rows = [valid_row] * 24 + [{**valid_row, "tenure": -1}]
    out = s.score_batch(v.validate(request(spark, *rows))).collect()
    assert len(out) == 25 and len({r["prediction_id"] for r in out}) == 25
    bad = [r for r in out if r["status"] == "invalid"]
    assert len(bad) == 1 and bad[0]["churn_probability"] is None and bad[0]["confidence"] is None
    assert {r["model_version"] for r in out} == {"unknown"}


def test_missing_features_take_their_defaults(spark):
    df = request(spark, {f.name: None for f in CUSTOMER_FIELDS})
    # month-to-month .30, tenure 12 .12, charges 65 .04, DSL .03, mailed check .02
    assert s.score_batch(df).first()["churn_probability"] == 0.51


@pytest.mark.parametrize("score, level", [(0.8, "high"), (0.2, "high"), (0.65, "medium"), (0.35, "medium"),
                                          (0.64, "low"), (0.5, "low"), (0.0, "high"), (1.0, "high"), (None, None)])
def test_confidence_bands(spark, score, level):
    df = spark.createDataFrame([(score,)], "x double")
    assert df.select(confidence_level("x")).first()[0] == level


def test_alternating_batch_bands(spark):
    rows = [(i, 0.5 + (i % 5) * 0.1) for i in range(10)]
    out = spark.createDataFrame(rows, "i int, x double").select(confidence_level(F.round("x", 4))).collect()
    assert [r[0] for r in out[:5]] == ["low", "low", "medium", "medium", "high"] or [r[0] for r in out[:5]][-1] == "high"


def test_clamp_and_rounding(spark):
    row = spark.createDataFrame([(-1.0, 2.0, 0.12345)], "a double, b double, c double").select(
        clamp("a"), clamp("b"), round_score("c")).first()
    assert tuple(row) == (0.01, 0.99, 0.1235)


def test_noise_is_bounded_and_seeded(spark, valid_row):
    df = request(spark, *[valid_row] * 50)
    a = [r[0] for r in df.select(s.rule_score(noise=0.05, seed=3)).collect()]
    assert all(abs(x - 0.44) <= 0.05 + 1e-9 for x in a) and len(set(a)) > 10


def test_elapsed(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 00:00:00' a, timestamp'2024-01-01 00:00:01.234565' b")
    assert tuple(df.select(elapsed_seconds("a", "b"), elapsed_ms("a", "b")).first()) == (1.235, 1234.57)


def test_grid_text(spark):
    df = spark.createDataFrame([([{"b": "2", "a": "1"}, {"a": "3"}],)], "g array<map<string,string>>")
    assert df.select(grid_string("g")).first()[0] == "a=1, b=2 | a=3"


# --- metrics ------------------------------------------------------------------------------------

def pairs_auc(rows):
    pos, neg = [x for x, y in rows if y], [x for x, y in rows if not y]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc_against_all_pairs(spark):
    rnd = random.Random(5)
    rows = [(round(rnd.random(), 2), int(rnd.random() < 0.4)) for _ in range(400)]
    df = spark.createDataFrame(rows, "score double, label int")
    exact = m.auc_roc(df, "score", "label").first()["auc_roc"]
    assert math.isclose(exact, pairs_auc(rows), rel_tol=1e-12)
    assert abs(m.auc_roc(df, "score", "label", bins=1000).first()["auc_roc"] - exact) < 1e-3
    one = m.evaluate_groups(df, "score", "label").first()
    assert math.isclose(one["auc_roc"], exact, rel_tol=1e-12)
    assert one["tp"] == sum(1 for x, y in rows if y and x >= 0.5)


def test_roc_points_rise_from_corner_to_corner(spark):
    rnd = random.Random(6)
    rows = [(round(rnd.random(), 1), int(rnd.random() < 0.5)) for _ in range(200)]
    pts = [(r["fpr"], r["tpr"]) for r in m.roc_curve(
        spark.createDataFrame(rows, "score double, label int"), "score", "label").collect()]
    pts.sort()
    assert pts[0] == (0.0, 0.0) and pts[-1] == (1.0, 1.0)
    assert len(pts) == len({x for x, _ in rows}) + 1
    assert all(a[0] <= b[0] and a[1] <= b[1] for a, b in zip(pts, pts[1:]))


def test_one_class_table(spark):
    df = spark.createDataFrame([(0.3, 1), (0.6, 1)], "score double, label int")
    assert {r["fpr"] for r in m.roc_curve(df, "score", "label").collect()} == {0.0}
    row = m.auc_roc(df, "score", "label").first()
    assert (row["auc_roc"], row["negatives"]) == (0.0, 0)


def test_weighted_metrics_match_ml(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    rnd = random.Random(7)
    rows = [(float(rnd.random() < 0.3), float(rnd.random() < 0.4)) for _ in range(300)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    mine = m.classification_metrics(df).first()
    for ours, theirs in (("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"),
                         ("weighted_recall", "weightedRecall"), ("weighted_f1", "f1")):
        value = MulticlassClassificationEvaluator(metricName=theirs).evaluate(df)
        assert math.isclose(mine[ours], value, rel_tol=1e-9)


# --- drift ----------------------------------------------------------------------------------------

def test_shifted_cohort_scores_higher(spark, valid_row):
    normal = {**valid_row, "tenure": 48, "Contract": "Two year", "PaymentMethod": "Mailed check", "MonthlyCharges": 30.0}
    base = request(spark, *[normal] * 5)
    moved = drift.shifted_cohort(base)
    first = moved.first()
    assert (first["tenure"], first["MonthlyCharges"], first["TotalCharges"]) == (1, 90.0, 90.0)
    report = {r["measure"]: r for r in drift.drift_report(s.score_batch(drift.cohorts(base, moved))).collect()}
    assert report["avg_probability"]["change"] > 0.4
    assert (report["churn_rate_pct"]["baseline"], report["churn_rate_pct"]["shifted"]) == (0.0, 100.0)


def test_progress_every_fifty(spark):
    rows = [("hot", i, 0.25 if i % 2 else None, bool(i % 4 == 1)) for i in range(1, 121)]
    df = spark.createDataFrame(rows, "cohort string, id long, churn_probability double, churn_prediction boolean")
    out = sorted((r["sent"], r["total"], round(r["churn_pct"], 3), r["avg_score"], r["errors"])
                 for r in drift.progress(df, "id").collect())
    assert out == [(50, 120, 52.0, 0.25, 25), (100, 120, 50.0, 0.25, 50)]


def test_version_numbers_follow_order(spark):
    df = spark.createDataFrame([("m", 3), ("m", 1), ("n", 2)], "name string, at int")
    got = {(r["name"], r["at"]): r["row_number"] for r in number_rows(df, "at", ["name"]).collect()}
    assert got == {("m", 1): 1, ("m", 3): 2, ("n", 2): 1}


def test_grouped_roc_has_fixed_points_per_group(spark):
    rows = [("a", 0.9, 1), ("a", 0.4, 0), ("b", 0.7, 0), ("b", 0.7, 1), ("c", None, 1)]
    out = m.roc_curve(spark.createDataFrame(rows, "g string, score double, label int"), "score", "label", ["g"], baseline=True)
    got = sorted((r["g"], r["series"], r["fpr"], r["tpr"]) for r in out.collect())
    assert got == [("a", "model", 0.0, 0.0), ("a", "model", 0.0, 1.0), ("a", "model", 1.0, 1.0),
                   ("a", "random", 0.0, 0.0), ("a", "random", 1.0, 1.0), ("b", "model", 0.0, 0.0),
                   ("b", "model", 1.0, 1.0), ("b", "random", 0.0, 0.0), ("b", "random", 1.0, 1.0)]
