"""The scoring and monitoring jobs on Structured Streaming.

Scoring uses the same functions as the batch job. Counters and trailing ranges are
streaming aggregates; each micro-batch appends the changed rows to a table, stamped with
the batch number, and ``latest`` reads the current value of every key. ``snapshot_to`` also keeps
snapshots of these values, so that ``read_latest`` reads as few files after a year as after a day.

Trailing ranges are built from panes: an event changes the one pane it falls into, and ranges are sums over
panes, either when the panes are read (``ranges_of_panes``, always up to date) or in a second
aggregate of the stream (``stream_ranges``, each range given out once, when the watermark has passed it).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.monitor import cover, quantile_name, seconds, sketch_ranges, sketched
from tidemark.operators.scoring import CUSTOMER_RULES, Term, score_batch, score_with_model
from tidemark.operators.validate import reject_large, typed, validate
from tidemark.spec import CUSTOMER_FIELDS, MAX_BATCH, Field


def read_stream(spark: SparkSession, path: str, schema: T.StructType, format: str = "parquet",
                files_per_batch: int | None = None, name_pattern: str | None = None) -> DataFrame:
    """Files arriving in a folder, with a stated schema; ``name_pattern`` picks files by name."""
    reader = spark.readStream.schema(schema).format(format)
    if name_pattern:
        reader = reader.option("pathGlobFilter", name_pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def score_stream(stream: DataFrame, rules: Sequence[Term] = CUSTOMER_RULES,
                 fields: Sequence[Field] = CUSTOMER_FIELDS, version: str | None = None,
                 key: str | None = None, model: PipelineModel | None = None, size: str | None = None,
                 max_batch: int = MAX_BATCH) -> DataFrame:
    """Validate and score arriving rows with the rules, or with a fitted model; stateless, so every row
    is answered once. ``size`` names the column of ``explode_batch`` with the rows of a row's batch: batches of
    more than ``max_batch`` rows are rejected as a whole."""
    checked = validate(stream, fields)
    rows = typed(reject_large(checked, size, max_batch) if size else checked, fields)
    if model is None:
        return score_batch(rows, rules, version, key)
    return score_with_model(rows, model, [f.name for f in fields if f.type != "string"], version, key)


def stream_counts(log: DataFrame, by: Sequence[str]) -> DataFrame:
    """Running counters per class, level or any other small set of labels."""
    return log.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def stream_rate(log: DataFrame, by: Sequence[str] = (), range: str = "5 minutes", step: str = "15 seconds",
                watermark: str = "1 minute", ts: str = "ts", value: str | None = None,
                quantiles: Sequence[float] = ()) -> DataFrame:
    """Rate, and approximate quantiles of ``value``, over trailing event-time ranges.

    Rows later than the watermark are dropped and finished ranges leave the state.
    """
    timed = log.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.percentile_approx(value, q).alias(quantile_name(q)) for q in quantiles if value]
    out = timed.groupBy(F.window(ts, range, step).alias("__w"), *by).agg(*aggs)
    return out.select(F.col("__w.start").alias("window_start"), *by, "n",
                      (F.col("n") / F.lit(float(seconds(range)))).alias("per_second"),
                      *[quantile_name(q) for q in quantiles if value])


def stream_panes(log: DataFrame, by: Sequence[str] = (), step: str = "15 seconds", watermark: str = "1 minute",
                 ts: str = "ts", value: str | None = None) -> DataFrame:
    """Counts of one-step panes (__slot, by, n), and with ``value`` its number and sketch: one row of state a pane
    and key, whatever the length of the ranges made of them. Rows later than the watermark are dropped."""
    timed = log.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    panes = timed.groupBy(F.window(ts, step).alias("__w"), *by).agg(
        F.count(F.lit(1)).alias("n"), *(sketched(value) if value else []))
    return panes.withColumn("__slot", F.col("__w.start")).drop("__w")


def ranges_of_panes(panes: DataFrame, range: str = "5 minutes", step: str = "15 seconds", by: Sequence[str] = (),
                    quantiles: Sequence[float] = ()) -> DataFrame:
    """Rate, and approximate quantiles if asked for, of the trailing ranges over a table of panes."""
    n = cover(panes.select("__slot", *by, "n"), range, step).groupBy("window_start", *by).agg(F.sum("n").alias("n"))
    out = n.withColumn("per_second", F.col("n") / F.lit(float(seconds(range))))
    if not quantiles:
        return out
    found = sketch_ranges(panes.select("__slot", *by, "__n", "__sketch"), quantiles, range, step, by)
    keys = [F.col(c).alias(f"__by_{c}") for c in ("window_start", *by)]
    right = found.select(*keys, *[quantile_name(q) for q in quantiles])
    same = F.lit(True)
    for c in ("window_start", *by):
        same = same & F.col(c).eqNullSafe(F.col(f"__by_{c}"))
    return out.join(right, same).select(*out.columns, *[quantile_name(q) for q in quantiles])


def stream_ranges(log: DataFrame, by: Sequence[str] = (), range: str = "5 minutes", step: str = "15 seconds",
                  watermark: str = "1 minute", ts: str = "ts", value: str | None = None,
                  quantiles: Sequence[float] = ()) -> DataFrame:
    """Trailing ranges as a stream to append: panes first, then sums (and merged sketches) of the panes of a range.

    The state has one row a pane and one a range and key; an event touches one of them.
    """
    timed = log.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    panes = timed.groupBy(F.window(ts, step).alias("__pane"), *by).agg(
        F.count(F.lit(1)).alias("n"), *(sketched(value) if value else []))
    merged = [F.sum("__n").alias("__n"), F.kll_merge_agg_double("__sketch").alias("__sketch")] if value else []
    ranges = panes.groupBy(F.window(F.window_time("__pane"), range, step).alias("__w"), *by).agg(F.sum("n").alias("n"), *merged)
    return ranges.select(
        F.col("__w.start").alias("window_start"), *by, "n", (F.col("n") / F.lit(float(seconds(range)))).alias("per_second"),
        *[F.when(F.col("__n") > 0, F.kll_sketch_get_quantile_double("__sketch", F.lit(float(q)))).alias(quantile_name(q))
          for q in quantiles if value])


def append_to(stream: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append finished rows to a parquet table, exactly once."""
    writer = stream.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start(path)


def update_to(stream: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append changed aggregate rows to a table with their batch number.

    A batch replayed after a failure overwrites its own folder, so nothing counts twice.
    """
    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch_number={batch}")

    writer = stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def latest(updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Current value of every key of a table written by ``update_to``."""
    values = [c for c in updates.columns if c not in (*keys, "batch_number")]
    newest = F.max_by(F.struct(*values), "batch_number")
    return updates.groupBy(*keys).agg(newest.alias("__v")).select(*keys, "__v.*")


# --- Snapshots ---------------------------------------------------------------------------------------

def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _numbers(spark: SparkSession, path: str) -> list[int]:
    """Batch numbers of the finished folders ``path/batch_number=N``."""
    files, place = _folder(spark, path)
    if not files.exists(place):
        return []
    out = []
    for found in files.listStatus(place):
        name = found.getPath().getName()
        done = spark._jvm.org.apache.hadoop.fs.Path(found.getPath(), "_SUCCESS")
        if name.startswith("batch_number=") and files.exists(done):
            out.append(int(name.partition("=")[2]))
    return sorted(out)


def _read_from(spark: SparkSession, path: str, schema: T.StructType, snapshots: list[int], batches: list[int]) -> DataFrame:
    parts = [f"{path}/{kind}/batch_number={n}" for kind, numbers in (("snapshots", snapshots), ("batches", batches)) for n in numbers]
    full = T.StructType([*schema.fields, T.StructField("batch_number", T.LongType())])
    return spark.read.schema(full).parquet(*parts) if parts else spark.createDataFrame([], full)


def snapshot_to(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], every: int = 100,
                available_now: bool = True) -> StreamingQuery:
    """Like ``update_to``, and after every ``every`` batches the current value of each key is written as a snapshot.

    Batches before the last snapshot but one, and older snapshots, are deleted: two are kept, so that a batch
    replayed after a failure finds all it needs, writes the same rows again and changes nothing.
    """
    schema = stream.schema

    def write(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        number = F.lit(batch).cast("long").alias("batch_number")
        rows.select("*", number).write.mode("overwrite").parquet(f"{path}/batches/batch_number={batch}")
        if (batch + 1) % every:
            return
        before = [n for n in _numbers(spark, f"{path}/snapshots") if n < batch]
        later = [n for n in _numbers(spark, f"{path}/batches") if (before[-1] if before else -1) < n <= batch]
        now = latest(_read_from(spark, path, schema, before[-1:], later), keys)
        now.select(*schema.names, number).write.mode("overwrite").parquet(f"{path}/snapshots/batch_number={batch}")
        old = before[-1] if before else -1
        for kind, limit in (("snapshots", old), ("batches", old + 1)):
            for n in _numbers(spark, f"{path}/{kind}"):
                if n < limit:
                    files, place = _folder(spark, f"{path}/{kind}/batch_number={n}")
                    files.delete(place, True)

    writer = stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def read_latest(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """Current value of every key of a table written by ``snapshot_to``: its last snapshot and the batches after it."""
    snapshots = _numbers(spark, f"{path}/snapshots")[-1:]
    later = [n for n in _numbers(spark, f"{path}/batches") if not snapshots or n > snapshots[0]]
    return latest(_read_from(spark, path, schema, snapshots, later), keys)
