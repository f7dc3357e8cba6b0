"""A journal of cross-validation fits, so that a tuning job that dies can go on where it stopped.

Every finished fit is one appended row. A fit is named by what decides its result: the rows (an order-free digest),
the columns, folds and seed, the classifier with all its parameters, and the fold. A restarted job reads the rows of
its own fits and runs the others; a job with other rows or settings finds none of them.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.sources.sinks import append_shared, read_shared

FITS = "study string, fit string, algorithm string, params string, fold int, auc double, at timestamp"


def _digest(what) -> str:
    return hashlib.md5(json.dumps(what, sort_keys=True, default=str).encode()).hexdigest()


def rows_digest(rows: DataFrame) -> str:
    """The same for the same rows in any order: their number and the sum of their hashes, from one pass."""
    hashed = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]).cast("decimal(38,0)")
    return _digest([list(rows.dtypes), *map(str, rows.agg(F.count(F.lit(1)), F.sum(hashed)).first())])


def fit_params(classifier, point: dict) -> dict[str, str]:
    """All parameters of a fit by name: the classifier's own, then the grid point's."""
    both = {**classifier.extractParamMap(), **point}
    return {"class": type(classifier).__name__, **{p.name: str(v) for p, v in both.items()}}


class FitJournal:
    """Finished fits in a table at ``path``; several threads, and several jobs, may add to it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def table(self) -> DataFrame:
        """All rows; empty while nothing has been written."""
        return read_shared(self.spark, self.path, FITS)

    def study(self, rows: DataFrame, *settings) -> str:
        return _digest([rows_digest(rows), *settings])

    def done(self, study: str) -> dict[tuple[str, int], float]:
        """AUC by (fit, fold); as many rows as the study has fits."""
        found = self.table().where(F.col("study") == study).groupBy("fit", "fold").agg(F.min_by("auc", "at").alias("auc"))
        return {(r["fit"], r["fold"]): r["auc"] for r in found.collect()}

    @staticmethod
    def fit_name(params: dict[str, str]) -> str:
        return _digest(params)

    def add(self, study: str, algorithm: str, params: dict[str, str], fold: int, auc: float) -> None:
        row = [(study, self.fit_name(params), algorithm, json.dumps(params, sort_keys=True), fold, float(auc))]
        rows = self.spark.createDataFrame(row, FITS.rsplit(",", 1)[0])
        append_shared(rows.withColumn("at", F.current_timestamp()).coalesce(1), self.path)
