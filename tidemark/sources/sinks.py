"""Files written next to a run. All are written by Spark tasks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.columns import fixed
from tidemark.session import work_dir


def write_importance(importance: DataFrame, path: str) -> None:
    """CSV ``feature,importance`` with a header and six decimals. One file: a row per column."""
    (importance.select("feature", fixed("importance", 6).alias("importance"))
     .coalesce(1).write.mode("overwrite").option("header", True).csv(path))


def write_json(rows: DataFrame, path: str) -> None:
    """Run configuration or model summary rows as JSON lines."""
    rows.write.mode("overwrite").json(path)


def write_exploration(summary: DataFrame, path: str) -> None:
    """The exploration summary as text lines ``section<TAB>name<TAB>value``."""
    summary.select(F.concat_ws("\t", "section", "name", "value").alias("value")).write.mode("overwrite").text(path)


def append(rows: DataFrame, path: str, by: tuple[str, ...] = ()) -> None:
    """Add rows to a registry, run or prediction-log table, in folders by the values of ``by``."""
    rows.write.mode("append").partitionBy(*by).parquet(path)


def append_shared(rows: DataFrame, path: str) -> None:
    """Add rows to a table that several jobs write: each write gets a folder of its own (entry=..), because writers to
    one folder clear away each other's unfinished files. ``read_shared`` reads such a table."""
    append(rows, f"{path}/entry={uuid.uuid4().hex}")


def read_shared(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All rows that ``append_shared`` wrote; an empty table while there are none."""
    try:
        return spark.read.schema(schema).parquet(path).drop("entry")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty marker file; False if it is there already. Of several callers exactly one gets True, provided
    that the store creates files exclusively, as HDFS and POSIX file systems do."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(place.getParent())
    if store.getUri().getScheme() == "file":  # Hadoop's local files check first and create later
        try:
            open(store.makeQualified(place).toUri().getPath(), "x").close()
            return True
        except FileExistsError:
            return False
    try:
        store.create(place, False).close()
        return True
    except Py4JJavaError:
        if not store.exists(place):
            raise
        return False


def materialize(rows: DataFrame, name: str) -> DataFrame:
    """Write rows to a new table in the shared work folder and read it back.

    Cuts the lineage: whatever follows, or is repeated after a lost executor, starts from files.
    """
    path = work_dir(rows.sparkSession, name)
    append(rows, path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


@contextmanager
def scratch(rows: DataFrame, name: str) -> Iterator[DataFrame]:
    """A table like that of ``materialize``, deleted from the shared folder afterwards."""
    spark = rows.sparkSession
    path = work_dir(spark, name)
    try:
        append(rows, path)
        yield spark.read.schema(rows.schema).parquet(path)
    finally:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
