"""Fitting, tuning and evaluating the three classifiers."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import ExitStack
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool
from threading import Event

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.columns import positive_score
from tidemark.operators.features import feature_stages
from tidemark.operators.journal import FitJournal, fit_params
from tidemark.operators.metrics import evaluate_groups
from tidemark.operators.split import cached, with_folds
from tidemark.sources.sinks import scratch
from tidemark.spec import FeatureSpec

FOLDS = 3


@dataclass(frozen=True)
class Algorithm:
    """A classifier with its display name, experiment name and parameter grid."""

    name: str
    experiment: str
    classifier: Estimator
    grid: list[dict]

    def grid_points(self) -> list[dict[str, str]]:
        return [{p.name: str(v) for p, v in point.items()} for point in self.grid]


@dataclass
class Tuned:
    """The refitted best model and the AUC of each grid point, averaged and per fold."""

    model: PipelineModel
    best: int
    mean_auc: list[float]
    fold_auc: list[list[float]] = field(repr=False, default_factory=list)


def algorithms(max_iter: int = 100, seed: int = 42, experiment: str = "tuning") -> dict[str, Algorithm]:
    """Classifiers and grids as tuned by the training job. Runs are filed under
    ``experiment`` and the short name of the algorithm."""
    lr = LogisticRegression(labelCol="label", featuresCol="features", maxIter=max_iter)
    rf = RandomForestClassifier(labelCol="label", featuresCol="features", seed=seed)
    gbt = GBTClassifier(labelCol="label", featuresCol="features", seed=seed)
    return {
        "lr": Algorithm("Logistic Regression", f"{experiment}/lr", lr, (
            ParamGridBuilder().addGrid(lr.regParam, [0.01, 0.1, 0.3])
            .addGrid(lr.elasticNetParam, [0.0, 0.5, 1.0]).build())),
        "rf": Algorithm("Random Forest", f"{experiment}/rf", rf, (
            ParamGridBuilder().addGrid(rf.numTrees, [50]).addGrid(rf.maxDepth, [5]).build())),
        "gbt": Algorithm("Gradient Boosted Trees", f"{experiment}/gbt", gbt, (
            ParamGridBuilder().addGrid(gbt.maxIter, [20, 50]).addGrid(gbt.maxDepth, [3, 5]).build())),
    }


def large_forest_grid(seed: int = 42, experiment: str = "tuning") -> Algorithm:
    """The wider random-forest grid of earlier runs."""
    rf = RandomForestClassifier(labelCol="label", featuresCol="features", seed=seed)
    return Algorithm("Random Forest", f"{experiment}/rf-large", rf, (
        ParamGridBuilder().addGrid(rf.numTrees, [50, 100, 200]).addGrid(rf.maxDepth, [5, 10, 15]).build()))


def auc_evaluator() -> BinaryClassificationEvaluator:
    return BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction",
                                         metricName="areaUnderROC")


def _effort(point: dict) -> float:
    """Rough relative cost of a grid point, to start the longest fits first."""
    values = {p.name: v for p, v in point.items()}
    return values.get("maxIter", 1) * values.get("numTrees", 1) * values.get("maxDepth", 1)


def run_in_threads(spark: SparkSession, work, tasks: Sequence, threads: int) -> list:
    """``work(task)`` of every task, from a few threads, in the order of the tasks.

    Each call gets a wrapper of its own. A wrapper copies the session's local properties once and puts that one copy
    into the thread that runs it: threads that share it overwrite and clear each other's execution ids, and a job
    dies now and then because the id it has just set is gone. After an error no further task is begun; those that
    run are waited for, so what they write is whole, and the first error is raised.
    """
    stop = Event()

    def one(task):
        if stop.is_set():
            return None
        try:
            return work(task)
        except BaseException:
            stop.set()
            raise

    with ThreadPool(max(1, min(threads, len(tasks)))) as pool:
        waiting = [pool.apply_async(inheritable_thread_target(spark)(one), (task,)) for task in tasks]
        for w in waiting:
            w.wait()
        return [w.get() for w in waiting]


class _Folds:
    """The prepared sides of each fold, and all rows prepared for the refit; made when first asked for.

    All folds stay while at most ``at_once`` are wanted; else they are made and dropped a few at a time.
    """

    def __init__(self, rows: DataFrame, spec: FeatureSpec, folds: int, at_once: int, held: ExitStack):
        self.rows, self.spec, self.folds, self.at_once, self.held = rows, spec, folds, at_once, held
        self.kept: dict[int, tuple[DataFrame, DataFrame]] = {}
        self.whole: tuple[list, DataFrame] | None = None

    def _prepare(self, chosen: list[int], held: ExitStack) -> dict[int, tuple[DataFrame, DataFrame]]:
        def prepare(fold: int) -> tuple[DataFrame, DataFrame]:
            rest, valid = self.rows.where(F.col("fold") != fold), self.rows.where(F.col("fold") == fold)
            prep = Pipeline(stages=feature_stages(self.spec)).fit(rest)
            return tuple(held.enter_context(scratch(prep.transform(side).select("features", "label"), "fold"))
                         for side in (rest, valid))

        sides = run_in_threads(self.rows.sparkSession, prepare, chosen, len(chosen))
        return {f: held.enter_context(cached(*pair)) for f, pair in zip(chosen, sides)}

    def groups(self, wanted: Sequence[int]) -> Iterator[dict[int, tuple[DataFrame, DataFrame]]]:
        """The wanted folds, as many at a time as may be held."""
        if self.at_once >= self.folds:
            self.kept.update(self._prepare([f for f in wanted if f not in self.kept], self.held))
            if wanted:
                yield {f: self.kept[f] for f in wanted}
            return
        for k in range(0, len(wanted), self.at_once):
            with ExitStack() as held:
                yield self._prepare(list(wanted[k:k + self.at_once]), held)

    def all_rows(self) -> tuple[list, DataFrame]:
        """The stages fitted on all rows, and the rows they prepared."""
        if self.whole is None:
            prep = Pipeline(stages=feature_stages(self.spec)).fit(self.rows)
            written = self.held.enter_context(scratch(prep.transform(self.rows).select("features", "label"), "prepared"))
            self.whole = prep.stages, self.held.enter_context(cached(written))[0]
        return self.whole


class Tuning:
    """Cross-validation of algorithms, one after another or together, over the same prepared folds.

    A context: prepared rows are written to the work folder and cached from there, and deleted at the end, so the
    thousands of short jobs of iterative fits carry a file scan, not the history of the table. With a ``journal``
    every finished fit is written down, and fits that it already has are not run again.
    """

    def __init__(self, train: DataFrame, spec: FeatureSpec, folds: int = FOLDS, parallelism: int = 8, seed: int = 42,
                 fold_parallelism: int | None = None, partitions: int | None = None, journal: FitJournal | None = None):
        if spec.key is None:
            raise ValueError("folds are assigned by hashing the key column: set spec.key")
        self.train, self.spec, self.folds, self.parallelism, self.seed = train, spec, folds, parallelism, seed
        self.at_once, self.partitions, self.journal = fold_parallelism or folds, partitions, journal
        self.study = None

    def __enter__(self) -> Tuning:
        self.held = ExitStack()
        spec = self.spec
        marked = with_folds(self.train, spec.key, self.folds, self.seed).select(*spec.features, spec.label, "fold")
        stored = self.held.enter_context(cached(marked))[0]
        rows = stored if self.partitions is None else stored.coalesce(self.partitions)
        self.prepared = _Folds(rows, spec, self.folds, self.at_once, self.held)
        if self.journal is not None:
            self.study = self.journal.study(stored, spec.numeric, spec.categorical, spec.label, self.folds)
        return self

    def __exit__(self, *error) -> None:
        self.held.close()

    def _aucs(self, algos: Mapping[str, Algorithm]) -> dict[tuple[str, int, int], float]:
        """Validation AUC of every (algorithm, grid point, fold)."""
        evaluator, spark = auc_evaluator(), self.train.sparkSession
        tasks = [(name, i, f) for name, algo in algos.items() for i in range(len(algo.grid)) for f in range(self.folds)]
        params = {(name, i): fit_params(algo.classifier, point) for name, algo in algos.items() for i, point in enumerate(algo.grid)}
        known = self.journal.done(self.study) if self.journal else {}
        out = {t: known[FitJournal.fit_name(params[t[:2]]), t[2]] for t in tasks
               if known and (FitJournal.fit_name(params[t[:2]]), t[2]) in known}
        open_ = sorted((t for t in tasks if t not in out), key=lambda t: -_effort(algos[t[0]].grid[t[1]]))
        for sides in self.prepared.groups(sorted({f for _, _, f in open_})):
            def one(task: tuple[str, int, int]) -> float:
                name, i, fold = task
                train, valid = sides[fold]
                auc = evaluator.evaluate(algos[name].classifier.fit(train, algos[name].grid[i]).transform(valid))
                if self.journal:
                    self.journal.add(self.study, algos[name].name, params[name, i], fold, auc)
                return auc

            now = [t for t in open_ if t[2] in sides]
            out.update(zip(now, run_in_threads(spark, one, now, self.parallelism)))
        return out

    def tune(self, algos: Mapping[str, Algorithm]) -> dict[str, Tuned]:
        """The best point by mean AUC of each algorithm, refitted on all rows."""
        aucs, out = self._aucs(algos), {}
        stages, ready = self.prepared.all_rows()
        for name, algo in algos.items():
            scores = [[aucs[name, i, f] for f in range(self.folds)] for i in range(len(algo.grid))]
            means = [sum(point) / self.folds for point in scores]
            best = max(range(len(means)), key=lambda i: means[i])
            out[name] = Tuned(PipelineModel(stages + [algo.classifier.fit(ready, algo.grid[best])]), best, means, scores)
        return out


def tune_many(train: DataFrame, spec: FeatureSpec, algos: Mapping[str, Algorithm], folds: int = FOLDS,
              parallelism: int = 8, seed: int = 42, fold_parallelism: int | None = None,
              partitions: int | None = None, journal: FitJournal | None = None) -> dict[str, Tuned]:
    """k-fold cross-validation of several algorithms over the same folds.

    ``fold_parallelism`` folds are prepared and held at a time, all of them unless given: a table that is
    large for the cluster takes 1. The rows keep their partitions unless ``partitions`` asks for fewer,
    which spares the many short jobs of a fit on a small table. Neither changes with the number of rows.

    The feature stages are fitted on the training part of each fold only. They do not depend
    on the classifier, so each fold is prepared once and every grid point of every algorithm is
    fitted on it. The best point by mean AUC is refitted on all rows. ``journal``: see ``Tuning``.
    """
    with Tuning(train, spec, folds, parallelism, seed, fold_parallelism, partitions, journal) as tuning:
        return tuning.tune(algos)


def tune(train: DataFrame, spec: FeatureSpec, algo: Algorithm, folds: int = FOLDS,
         parallelism: int = 8, seed: int = 42, fold_parallelism: int | None = None,
         partitions: int | None = None, journal: FitJournal | None = None) -> Tuned:
    return tune_many(train, spec, {"one": algo}, folds, parallelism, seed, fold_parallelism, partitions, journal)["one"]


def tuning_table(spark: SparkSession, algo: Algorithm, tuned: Tuned) -> DataFrame:
    """One row per grid point: parameters, mean AUC, whether it was chosen."""
    rows = [(algo.name, i, point, float(auc), i == tuned.best)
            for i, (point, auc) in enumerate(zip(algo.grid_points(), tuned.mean_auc))]
    return spark.createDataFrame(
        rows, "algorithm string, point int, params map<string,string>, mean_auc double, chosen boolean")


def usable(spec: FeatureSpec) -> Column:
    """Rows that a fit can use: every number is there. The assembler leaves the others out."""
    out = F.lit(True)
    for name in spec.numeric:
        out = out & F.col(name).isNotNull()
    return out


def fit_once(train: DataFrame, spec: FeatureSpec, algo: Algorithm, point: int = 0,
             partitions: int | None = None) -> PipelineModel:
    """Fit the stages and one grid point of the classifier on all rows (``partitions`` as in ``tune_many``)."""
    with cached(train.select(*spec.features, spec.label)) as (stored,):
        rows = stored if partitions is None else stored.coalesce(partitions)
        prep = Pipeline(stages=feature_stages(spec)).fit(rows)
        with scratch(prep.transform(rows).select("features", "label"), "prepared") as written, cached(written) as (ready,):
            return PipelineModel(prep.stages + [algo.classifier.fit(ready, algo.grid[point])])


def predict(model: PipelineModel, rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Label, prediction and positive score of each row."""
    return model.transform(rows).select(*keep, "label", "prediction", positive_score().alias("score"))


def evaluate(model: PipelineModel, test: DataFrame) -> dict[str, float]:
    """AUC, accuracy, weighted precision, recall and F1 on the test side, from one pass that
    counts labels per distinct score. A single row comes back."""
    row = evaluate_groups(predict(model, test), "score", "label", prediction="prediction").first()
    return {"auc_roc": row["auc_roc"], "accuracy": row["accuracy"], "precision": row["weighted_precision"],
            "recall": row["weighted_recall"], "f1_score": row["weighted_f1"]}


@dataclass
class TrainedRun:
    """One finished run: its parameters, metrics and model."""

    run_id: str
    algorithm: str
    experiment: str
    params: dict[str, str]
    metrics: dict[str, float]
    model: PipelineModel
    mean_auc: list[float]
    started: float
    ended: float


def training_params(algorithm: str, grid: Sequence[Mapping[str, str]], spec: FeatureSpec,
                    training_rows: int, folds: int = FOLDS, fraction: float = 0.8) -> dict[str, str]:
    """The parameters recorded for a run. Folds and split are the values really used."""
    text = " | ".join(", ".join(f"{k}={v}" for k, v in sorted(point.items())) for point in grid)
    return {"algorithm": algorithm, "num_cv_folds": str(folds), "train_test_split": f"{100 * fraction:g}/{100 - 100 * fraction:g}",
            "feature_count": str(len(spec.features)), "training_rows": str(training_rows),
            "param_grid_size": str(len(grid)), "param_grid": text}


class Recorder:
    """Told of every run while it exists. This one keeps nothing; ``operators.runs.RunLog`` writes tables."""

    def started(self, run_id: str, algorithm: Algorithm, params: Mapping[str, str], at: float) -> None:
        pass

    def finished(self, run: TrainedRun) -> None:
        pass

    def failed(self, run_id: str, algorithm: Algorithm, reason: str, at: float) -> None:
        pass


def train_all(train: DataFrame, test: DataFrame, spec: FeatureSpec,
              algos: Mapping[str, Algorithm] | None = None, folds: int = FOLDS,
              parallelism: int = 8, seed: int = 42, fold_parallelism: int | None = None,
              partitions: int | None = None, journal: FitJournal | None = None,
              recorder: Recorder | None = None) -> list[TrainedRun]:
    """Tune, refit and evaluate each algorithm on the same cached split and the same prepared folds.
    ``training_rows`` of a run are the rows that the fit used.

    ``recorder`` hears of a run and its parameters before the run's first fit, and of its metrics as soon as it
    is done; a run that raises is reported with the reason, and the error goes on to the caller.
    """
    algos = algorithms() if algos is None else algos
    recorder = recorder or Recorder()
    runs = []
    with cached(train, test) as (tr, te):
        n = tr.where(usable(spec)).count()
        with Tuning(tr, spec, folds, parallelism, seed, fold_parallelism, partitions, journal) as tuning:
            for name, algo in algos.items():
                run_id, started = uuid.uuid4().hex, time.time()
                params = training_params(algo.name, algo.grid_points(), spec, n, folds)
                recorder.started(run_id, algo, params, started)
                try:
                    tuned = tuning.tune({name: algo})[name]
                    ended = time.time()
                    metrics = evaluate(tuned.model, te)
                except BaseException as error:
                    recorder.failed(run_id, algo, f"{type(error).__name__}: {error}".splitlines()[0][:500], time.time())
                    raise
                metrics["training_duration_seconds"] = ended - started
                run = TrainedRun(run_id, algo.name, algo.experiment, params, metrics, tuned.model, tuned.mean_auc, started, ended)
                recorder.finished(run)
                runs.append(run)
    return runs
