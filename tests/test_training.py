"""Feature stages, tuning, importance, models and streams."""

import random
from collections import Counter

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.operators import features as fe, importance, scoring, split, training as tr
from tidemark.sources import models, sinks
from tidemark.spec import FeatureSpec

SPEC = FeatureSpec(("color",), ("size",), "y", "k")


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(3)
    data = []
    for i in range(400):
        color, size = rnd.choice(["red", "red", "red", "blue", "blue", "green"]), rnd.random()
        data.append((i, color, size, "Yes" if size + 0.3 * (color == "red") + 0.2 * rnd.random() > 0.8 else "No"))
    return spark.createDataFrame(data, "k int, color string, size double, y string")


@pytest.fixture(scope="module")
def model(rows):
    return tr.fit_once(rows, SPEC, tr.algorithms()["rf"])


def test_unseen_category_is_all_zero(spark, rows):
    enc = Pipeline(stages=[fe.category_indexers(SPEC), fe.one_hot(SPEC)]).fit(rows)
    new = spark.createDataFrame([("violet",), ("red",)], "color string")
    got = [list(r[0]) for r in enc.transform(new).select(vector_to_array("color_vec")).collect()]
    assert got == [[0.0, 0.0, 0.0], [1.0, 0.0, 0.0]]


def test_ties_in_frequency_are_alphabetical(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "color string")
    got = {r["value"]: r["index"] for r in fe.category_index(df, ["color"]).collect()}
    assert got == {"c": 0, "a": 1, "b": 2}
    assert list(fe.category_indexers(SPEC).fit(df).labelsArray[0]) == ["c", "a", "b"]


def _kept_plainly(values, most):
    counts = Counter(v for v in values if v is not None)
    total = sum(counts.values())
    return {v: n for v, n in counts.items() if len(counts) <= most or n * most > total}


@pytest.mark.parametrize("most", [1, 3, 100, 5000])
def test_kept_categories_of_many_values(spark, most):
    """Against plain counting: a few hot values among many rare ones, exactly ``most`` values, none at all."""
    df = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, F.concat(F.lit("m"), (F.col("id") % 7).cast("string")))
        .when(F.col("id") % 11 == 0, None).otherwise(F.col("id").cast("string")).alias("many"),
        (F.col("id") % 100).cast("string").alias("hundred"), F.lit(None).cast("string").alias("none"),
        F.col("id").cast("string").alias("a.b"))
    df = df.withColumnRenamed("a.b", "unique").repartition(7)
    kept = fe.kept_categories(df, df.columns, most)
    got = {c: {} for c in df.columns}
    for r in kept.collect():
        got[r["column_name"]][r["value"]] = r["count"]
    rows = df.collect()
    assert got == {c: _kept_plainly([r[c] for r in rows], most) for c in df.columns}
    loss = {r["column_name"]: (r["kept_values"], r["rows"], r["rows_lost"]) for r in fe.category_loss(df, kept, df.columns).collect()}
    changed = fe.keep_categories(df, kept, df.columns)
    left = changed.agg(*[F.count(c).alias(c) for c in df.columns]).first()
    for c in df.columns:
        rows_of = sum(r[c] is not None for r in rows)
        assert loss[c] == (len(got[c]), rows_of, rows_of - left[c])


def test_kept_categories_of_nothing(spark, rows):
    assert fe.kept_categories(rows.limit(0), ["color"]).isEmpty()
    kept = fe.kept_categories(rows, ["color"])
    assert fe.keep_categories(rows, kept, ["color"]).exceptAll(rows).isEmpty()
    with pytest.raises(ValueError):
        fe.kept_categories(rows, ["color"], 0)


def test_dropped_categories_take_the_unseen_slot(spark, rows):
    rows = rows.union(rows.where("color = 'red'"))  # above half of the rows
    kept = fe.kept_categories(rows, ["color"], 2)
    few = fe.keep_categories(rows, kept, ["color"])
    fitted = Pipeline(stages=[fe.category_indexers(SPEC), fe.one_hot(SPEC)]).fit(few)
    assert list(fitted.stages[0].labelsArray[0]) == ["red"]
    for table in (few, rows):  # scoring data keep their rare values
        vec = fitted.transform(table).where("color IS NULL OR color <> 'red'").select(vector_to_array("color_vec"))
        assert {tuple(r[0]) for r in vec.collect()} == {(0.0,)}


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0)], "a double, b double")
    assert [(round(r["a_std"], 4), r["b_std"]) for r in fe.standardize(df, ["a", "b"]).collect()] == [(-0.7071, 0.0), (0.7071, 0.0)]


def test_positive_class_is_yes_even_when_it_is_the_majority(spark):
    df = spark.createDataFrame([("Yes",), ("Yes",), ("No",)], "y string")
    assert [r["label"] for r in fe.label_indexer(SPEC).fit(df).transform(df).collect()] == [1.0, 1.0, 0.0]


def test_importance_names_follow_the_vector(spark, model):
    slots = importance.slot_importance(spark, model).orderBy("idx").collect()
    assert [(r["feature"], r["slot"]) for r in slots] == [
        ("color", "color=red"), ("color", "color=blue"), ("color", "color=green"), ("size", "size")]
    per_column = importance.feature_importance(spark, model).collect()
    assert per_column[0]["feature"] == "size" and abs(sum(r["importance"] for r in per_column) - 1) < 1e-9


def test_importance_file(spark, model, tmp_path):
    path = str(tmp_path / "importance")
    sinks.write_importance(importance.feature_importance(spark, model), path)
    lines = sorted(r[0] for r in spark.read.text(path).collect())
    assert "feature,importance" in lines and all(len(x.split(".")[-1]) == 6 for x in lines if "." in x)


def test_model_scores_every_row(spark, model):
    new = spark.createDataFrame([(1, "red", 0.9), (2, "violet", 0.1), (3, "red", None)], "k int, color string, size double")
    out = {r["k"]: r for r in scoring.score_with_model(new, model, SPEC.numeric, "1", "k").collect()}
    assert len(out) == 3 and out[3]["churn_probability"] is None
    assert out[1]["churn_prediction"] and not out[2]["churn_prediction"]


def test_saved_model_scores_the_same(rows, model, tmp_path):
    from pyspark.ml import PipelineModel
    back = PipelineModel.load(models.save_model(model, str(tmp_path / "m")))
    a, b = (tr.predict(x, rows, ["k"]) for x in (model, back))
    assert a.exceptAll(b).isEmpty()


def test_tuning_equals_the_library_cross_validator(rows):
    """Same folds, same grid: preparing each fold once changes no average."""
    from pyspark.ml.tuning import CrossValidator
    from tidemark.operators.split import with_folds
    algo = tr.algorithms()["lr"]
    algo = tr.Algorithm(algo.name, algo.experiment, algo.classifier, algo.grid[:2])
    tuned = tr.tune(rows, SPEC, algo)
    cv = CrossValidator(estimator=Pipeline(stages=[*fe.feature_stages(SPEC), algo.classifier]),
                        estimatorParamMaps=algo.grid, evaluator=tr.auc_evaluator(), numFolds=3, foldCol="fold")
    theirs = cv.fit(with_folds(rows, "k", 3)).avgMetrics
    assert tuned.mean_auc == pytest.approx(theirs, abs=1e-9)
    assert tuned.mean_auc[tuned.best] == max(tuned.mean_auc) > 0.9


def test_grids():
    sizes = {k: len(a.grid) for k, a in tr.algorithms().items()}
    assert sizes == {"lr": 9, "rf": 1, "gbt": 4} and len(tr.large_forest_grid().grid) == 9


def test_train_all_fills_the_run_tables(spark, rows):
    from tidemark.operators import runs
    from tidemark.operators.split import split
    algos = {k: tr.Algorithm(a.name, a.experiment, a.classifier, a.grid[:1]) for k, a in tr.algorithms(max_iter=20).items() if k != "gbt"}
    done = tr.train_all(*split(rows, key="k"), SPEC, algos)
    events, params, metrics = runs.runs_tables(spark, done)
    assert {r["status"] for r in runs.run_states(events).collect()} == {"FINISHED"}
    view = runs.run_view(metrics, params).collect()
    assert len(view) == 2 and all(r["auc_roc"] > 0.8 and r["num_cv_folds"] == "3" for r in view)


def test_work_folder_needs_a_setting_on_a_cluster(spark):
    from tidemark import session
    root = session.work_root(spark)
    assert session.work_dir(spark, "x").startswith(root) and session.work_dir(spark, "x") != session.work_dir(spark, "x")


def test_split_uses_the_whole_hash(spark):
    """A fraction between two percents is kept, and rows without a key go to one side and one fold."""
    rows = spark.range(20000).selectExpr("id AS k").union(spark.createDataFrame([(None,)] * 5, "k long"))
    train, test = split.split(rows, 0.996, 42, "k")
    assert 40 < test.where("k IS NOT NULL").count() < 130 and train.count() + test.count() == 20005
    assert split.with_split(rows.where("k IS NULL"), "k").select("side").distinct().count() == 1
    folds = {r["fold"] for r in split.with_folds(rows, "k").where("k IS NULL").collect()}
    assert len(folds) == 1 and folds <= {0, 1, 2}


def _lr(points=3):
    algo = tr.algorithms(max_iter=20)["lr"]
    return tr.Algorithm(algo.name, algo.experiment, algo.classifier, algo.grid[:points])


class Dies(Exception):
    pass


def _counted(monkeypatch, after=None):
    """Count the fits of grid points; the one after ``after`` fits dies."""
    from pyspark.ml.classification import LogisticRegression
    fits, fit = [], LogisticRegression.fit

    def counting(self, rows, params=None):
        fits.append(params)
        if after is not None and len(fits) > after:
            raise Dies("the machine is gone")
        return fit(self, rows, params)

    monkeypatch.setattr(LogisticRegression, "fit", counting)
    return fits


def test_tuning_goes_on_where_it_died(spark, rows, tmp_path, monkeypatch):
    from tidemark.operators.journal import FitJournal
    want = tr.tune(rows, SPEC, _lr())
    journal = FitJournal(spark, str(tmp_path / "fits"))
    with monkeypatch.context() as m:
        _counted(m, after=4)
        with pytest.raises(Dies):
            tr.tune(rows, SPEC, _lr(), parallelism=2, journal=journal)
    kept = journal.table().count()
    assert 3 <= kept <= 4
    with monkeypatch.context() as m:
        fits = _counted(m)
        got = tr.tune(rows.repartition(3), SPEC, _lr(), journal=journal)  # the same rows in other partitions
        assert len(fits) == 9 - kept + 1  # the missing ones, and the refit
    assert sum(got.fold_auc, []) == pytest.approx(sum(want.fold_auc, []), abs=1e-12)  # sums run in another order
    assert got.best == want.best
    with monkeypatch.context() as m:
        fits = _counted(m)
        assert tr.tune(rows, SPEC, _lr(), journal=journal, fold_parallelism=1).fold_auc == got.fold_auc and len(fits) == 1
        tr.tune(rows, SPEC, _lr(1), folds=2, journal=journal)
        tr.tune(rows.where("k > 5"), SPEC, _lr(1), journal=journal)
        assert len(fits) == 1 + (2 + 1) + (3 + 1)  # other folds, other rows: nothing of the journal counts


def test_a_failing_fit_leaves_a_failed_run_and_the_finished_ones(spark, rows, tmp_path, monkeypatch):
    from pyspark.ml.classification import RandomForestClassifier
    from tidemark import jobs
    from tidemark.operators import runs
    algos = {"lr": _lr(1), "rf": tr.algorithms()["rf"]}
    seen = []

    def fit(self, *args):
        seen.append({(r["status"], r["reason"]) for r in jobs.stored(spark, str(tmp_path), "run_events").collect()})
        raise Dies("no room\nfor trees")

    monkeypatch.setattr(RandomForestClassifier, "fit", fit)
    with pytest.raises(Dies):
        jobs.training_job(rows, SPEC, str(tmp_path), "m", algos, folds=2)
    assert seen[0] == {("RUNNING", None), ("FINISHED", None)}  # the forest's run exists before its first fit
    events = jobs.stored(spark, str(tmp_path), "run_events")
    states = {r["run_id"]: r["status"] for r in runs.run_states(events).collect()}
    assert sorted(states.values()) == ["FAILED", "FINISHED"]
    failed = runs.run_failures(events).first()
    assert failed["reason"] == "Dies: no room" and states[failed["run_id"]] == "FAILED"
    params = jobs.stored(spark, str(tmp_path), "run_params").where(F.col("run_id") == failed["run_id"])
    assert {r["key"]: r["value"] for r in params.collect()}["algorithm"] == "Random Forest"
    assert {r["run_id"] for r in jobs.stored(spark, str(tmp_path), "run_metrics").collect()} == set(states) - {failed["run_id"]}
    monkeypatch.undo()
    fits = _counted(monkeypatch)
    assert jobs.training_job(rows, SPEC, str(tmp_path), "m", algos, folds=2).first()["version"] == 1
    assert len(fits) == 1  # the folds of the regression are in the journal, the refit is not
    states = [r["status"] for r in runs.run_states(jobs.stored(spark, str(tmp_path), "run_events")).collect()]
    assert sorted(states) == ["FAILED", "FINISHED", "FINISHED", "FINISHED"]


def test_abandoned_runs_are_closed(spark):
    from tidemark.operators import runs
    events = spark.createDataFrame([("a", "e", "RUNNING", 100), ("b", "e", "RUNNING", 100), ("b", "e", "FINISHED", 150),
                                    ("c", "e", "RUNNING", 900)], "run_id string, experiment_id string, status string, at long") \
        .withColumn("at", F.timestamp_seconds("at")).withColumn("reason", F.lit(None).cast("string"))
    more = runs.abandoned(events, F.timestamp_seconds(F.lit(500)))
    both = runs.run_failures(events.unionByName(more)).collect()
    assert [(r["run_id"], r["reason"]) for r in both] == [("a", "abandoned")]


def test_threads_do_not_share_local_properties(spark):
    """Each task has properties of its own: what one sets, or clears, no other sees."""
    import time
    sc = spark.sparkContext

    def own(i):
        sc.setLocalProperty("tidemark.test", str(i))
        time.sleep(0.05)
        return sc.getLocalProperty("tidemark.test")

    assert tr.run_in_threads(spark, own, list(range(24)), 8) == [str(i) for i in range(24)]
    done = []

    def some_die(i):
        if i == 3:
            raise Dies(i)
        time.sleep(0.05)
        done.append(i)

    with pytest.raises(Dies):
        tr.run_in_threads(spark, some_die, list(range(50)), 2)
    assert len(done) < 10
    assert tr.run_in_threads(spark, own, [], 4) == []


def test_document_features_by_hand(spark, tmp_path):
    """Runs of characters are dropped at once; a run may be as long as the text."""
    from tidemark.plans.views import document_features
    texts = ["a1 b2, b2!\n٣ é-", "", "x" * 1_000_000 + "7", None]
    (spark.createDataFrame([(k, t, "en", "web", len(t or "")) for k, t in enumerate(texts)],
                           "doc_id long, text string, lang string, source string, n_chars long")
     .write.parquet(f"{tmp_path}/documents.parquet"))
    rows = {r["doc_id"]: r for r in document_features(spark, str(tmp_path), None).collect()}
    assert (rows[0]["digit_ratio"], rows[0]["punct_ratio"]) == (3 / 15, 5 / 15)  # , ! ٣ é -
    assert (rows[0]["n_words"], rows[0]["n_lines"]) == (5.0, 2.0)
    assert (rows[1]["digit_ratio"], rows[2]["digit_ratio"], rows[2]["punct_ratio"]) == (0.0, 1 / 1_000_001, 0.0)
    assert rows[3]["digit_ratio"] is None
