"""Monitoring aggregates over the request and prediction log.

Trailing ranges are built in two steps: the log is first counted per step-long slot,
then each small slot row is added to every range that covers it. The log is never
copied once per overlapping range.
"""

from __future__ import annotations

import builtins
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.columns import bool_label, status_band
from tidemark.operators.running import quantile_name, running_totals, with_range
from tidemark.spec import LEVELS

INF = "+Inf"


def seconds(span: str) -> int:
    return int(pd.Timedelta(span).total_seconds())


def cover(slots: DataFrame, range: str, step: str) -> DataFrame:
    """One row per range start covering the slot; ranges start on multiples of ``step``."""
    back = seconds(range) - seconds(step)
    if back < 0 or seconds(range) % seconds(step):
        raise ValueError("range must be a multiple of step")
    starts = F.expr(f"sequence(__slot - interval {back} seconds, __slot, interval {seconds(step)} seconds)")
    return slots.withColumn("window_start", F.explode(starts)).drop("__slot")


def trailing(log: DataFrame, sums: Mapping[str, Column], range: str, step: str, by: Sequence[str] = (),
             ts: str = "ts") -> DataFrame:
    """Sum the given columns over each trailing range, per group; ``window_start`` is its start."""
    slots = log.groupBy(F.window(ts, step).start.alias("__slot"), *by).agg(
        *[F.sum(c).alias(n) for n, c in sums.items()])
    return cover(slots, range, step).groupBy("window_start", *by).agg(*[F.sum(n).alias(n) for n in sums])


def with_silent(ranges: DataFrame, step: str, by: Sequence[str] = (), start: str = "window_start") -> DataFrame:
    """The ranges of each series and, between its first and its last, those in which nothing came: their counts are 0,
    all else is null. As many rows a series as it has steps from first to last, whatever its traffic; series are
    compared with their null keys."""
    spans = ranges.groupBy(*by).agg(F.min(start).alias("__first"), F.max(start).alias("__last"))
    every = spans.where("__first IS NOT NULL").select(
        *by, F.explode(F.expr(f"sequence(__first, __last, interval {seconds(step)} seconds)")).alias("__at"))
    right = ranges.select(*[F.col(c).alias(f"__{c}") for c in ranges.columns])
    same = F.col("__at") == F.col(f"__{start}")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    joined = every.join(right, same, "left")
    whole = {f.name for f in ranges.schema if f.dataType.typeName() in ("integer", "long", "short", "byte")}
    return joined.select(*[
        F.col("__at").alias(c) if c == start else F.col(c) if c in by
        else F.coalesce(F.col(f"__{c}"), F.lit(0)).alias(c) if c in whole else F.col(f"__{c}").alias(c)
        for c in ranges.columns])


def _one(condition: Column | None = None) -> Column:
    return F.lit(1) if condition is None else F.when(condition, 1).otherwise(0)


def rate(log: DataFrame, by: Sequence[str] = (), range: str = "1 minute", step: str = "15 seconds",
         ts: str = "ts", silent: bool = False) -> DataFrame:
    """Events per second over each trailing range; with ``silent`` also the ranges without any, as 0."""
    counts = trailing(log, {"n": _one()}, range, step, by, ts)
    counts = with_silent(counts, step, by) if silent else counts
    return counts.withColumn("per_second", F.col("n") / F.lit(float(seconds(range))))


def latency_quantiles(log: DataFrame, quantiles: Sequence[float] = (0.5, 0.95), range: str = "5 minutes",
                      step: str = "15 seconds", by: Sequence[str] = (), value: str = "latency_s",
                      ts: str = "ts", exact: bool = True) -> DataFrame:
    """Latency quantiles over each trailing range: exact (see ``selected_quantiles``), or approximate from one
    sketch per slot (rank error about 1.3 percent), whatever the traffic."""
    if exact:
        return selected_quantiles(log, value, quantiles, range, step, by, ts)
    slots = log.groupBy(F.window(ts, step).start.alias("__slot"), *by).agg(*sketched(value))
    return sketch_ranges(slots, quantiles, range, step, by)


def sketched(value: str) -> list[Column]:
    """How many values a slot has, and a mergeable sketch of them."""
    return [F.count(value).alias("__n"), F.kll_sketch_agg_double(F.col(value).cast("double")).alias("__sketch")]


def sketch_ranges(slots: DataFrame, quantiles: Sequence[float], range: str, step: str, by: Sequence[str] = ()) -> DataFrame:
    """Approximate quantiles of each trailing range from the sketches of its slots (__slot, by, __n, __sketch)."""
    ranges = cover(slots, range, step).groupBy("window_start", *by).agg(
        F.sum("__n").alias("n"), F.kll_merge_agg_double("__sketch").alias("__sketch"))
    return ranges.select("window_start", *by, "n", *[
        F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("__sketch", F.lit(float(q)))).alias(quantile_name(q))
        for q in quantiles])


def selected_quantiles(log: DataFrame, value: str, quantiles: Sequence[float], range: str, step: str,
                       by: Sequence[str] = (), ts: str = "ts", buckets: int = 256) -> DataFrame:
    """Exact quantiles (linear interpolation) over each trailing range, found by selection in two passes.

    The values are cut into ``buckets`` at approximate quantiles. First the buckets are counted: per slot before the
    shuffle, then per range, so fixed counters tell in which bucket each wanted rank lies. Then only values of such
    buckets are moved, each to the ranges that want its bucket, and ranked there: well under one copy of the log,
    where every range used to take a copy of all its values. The buckets only decide what is moved; the result is exact.
    """
    cuts = [i / buckets for i in builtins.range(1, buckets)]
    present = log.where(F.col(value).isNotNull()).select(
        F.window(ts, step).start.alias("__slot"), *by, F.col(value).alias("__value"))
    bounds = present.agg(F.percentile_approx("__value", cuts, 10 * buckets)).scalar()
    placed = with_range(present.withColumn("__bounds", bounds), "__value", len(cuts)).withColumnRenamed("__range", "__bucket")

    counted = placed.groupBy("__slot", *by, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    ranges = cover(counted, range, step).groupBy("window_start", *by, "__bucket").agg(F.sum("__n").alias("__n"))
    group = Window.partitionBy("window_start", *by)  # at most ``buckets`` rows
    below = group.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumns({"__below": F.coalesce(F.sum("__n").over(below), F.lit(0)), "__all": F.sum("__n").over(group)})

    def spot(q: float) -> tuple[Column, Column, Column]:
        place = F.lit(float(q)) * (F.col("__all") - 1)
        return place, F.floor(place), F.ceil(place)

    def inside(index: Column) -> Column:
        return (F.col("__below") <= index) & (index < F.col("__below") + F.col("__n"))

    wanted = F.lit(False)
    for q in quantiles:
        _, low, high = spot(q)
        wanted = wanted | inside(low) | inside(high)
    hit = ranges.where(wanted).drop("__n")
    ahead = seconds(range) - seconds(step)
    of_slots = hit.withColumn("__slot", F.explode(F.expr(
        f"sequence(window_start, window_start + interval {ahead} seconds, interval {seconds(step)} seconds)")))
    right = of_slots.select(F.col("__slot").alias("__s"), F.col("__bucket").alias("__r"), "window_start", "__below", "__all",
                            *[F.col(c).alias(f"__by_{c}") for c in by])
    same = (F.col("__slot") == F.col("__s")) & (F.col("__bucket") == F.col("__r"))
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__by_{c}"))
    values = placed.join(right, same).groupBy("window_start", *by, "__bucket", "__below", "__all", "__value").agg(
        F.count(F.lit(1)).alias("__n"))
    ranked = running_totals(values, "__value", {"n": F.col("__n")}, ["window_start", *by, "__bucket"])
    ranked = ranked.withColumn("__below", F.col("__below") + F.col("n_run") - F.col("__n"))
    out = []
    for q in quantiles:
        place, low, high = spot(q)
        share = F.max(place - low)
        at = [F.max(F.when(inside(i), F.col("__value"))) for i in (low, high)]
        out.append((at[0] * (1 - share) + at[1] * share).alias(quantile_name(q)))
    return ranked.groupBy("window_start", *by).agg(F.max("__all").alias("n"), *out)


def error_rate(log: DataFrame, range: str, step: str, by: Sequence[str] = (), ts: str = "ts",
               status: str = "status", silent: bool = False) -> DataFrame:
    """Percentage of answers with status 400 and above over each trailing range; with ``silent`` it is 0 where
    nothing was answered, so that an alert on a dead service has a row to look at."""
    sums = {"n": _one(), "errors": _one(F.col(status) >= 400)}
    out = trailing(log, sums, range, step, by, ts)
    out = with_silent(out, step, by) if silent else out
    share = F.when(F.col("n") > 0, 100 * F.col("errors") / F.col("n"))
    return out.withColumn("error_pct", F.coalesce(share, F.lit(0.0)))


def total_error_rate(log: DataFrame, status: str = "status") -> DataFrame:
    """The same over the whole log; 0 when there was no traffic."""
    return log.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(status) >= 400).alias("errors")).withColumn(
        "error_pct", F.when(F.col("n") > 0, 100 * F.col("errors") / F.col("n")).otherwise(F.lit(0.0)))


def totals(log: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return log.groupBy(*by).agg(F.count(F.lit(1)).alias("requests"))


def avg_latency(log: DataFrame, range: str, step: str, by: Sequence[str] = (), ts: str = "ts",
                value: str = "latency_s", silent: bool = False) -> DataFrame:
    """Sum of latencies over their count, per trailing range; a silent range has no mean."""
    sums = {"n": _one(F.col(value).isNotNull()), "latency_sum": F.col(value)}
    out = trailing(log, sums, range, step, by, ts)
    out = with_silent(out, step, by) if silent else out
    return out.withColumn("avg_latency", F.when(F.col("n") > 0, F.col("latency_sum").cast("double") / F.col("n")))


def prediction_counts(log: DataFrame, prediction: str = "churn_prediction") -> DataFrame:
    """Predictions by class, labelled true/false."""
    return (log.where(F.col(prediction).isNotNull()).groupBy(bool_label(prediction).alias("prediction"))
            .agg(F.count(F.lit(1)).alias("predictions")))


def confidence_counts(log: DataFrame, level: str = "confidence", by: Sequence[str] = ()) -> DataFrame:
    """Scored rows per confidence level; a level that never occurred counts 0."""
    wide = log.groupBy(*by).agg(*[F.count_if(F.col(level) == name).alias(name) for name in LEVELS])
    pairs = F.array(*[F.struct(F.lit(n).alias("level"), F.col(n).alias("predictions")) for n in LEVELS])
    return wide.select(*by, F.inline(pairs))


# --- Histograms -------------------------------------------------------------------------------

def bound_label(bound: float) -> str:
    return str(float(bound))


def _bucket_sums(value: str, bounds: Sequence[float]) -> dict[str, Column]:
    v = F.col(value)
    sums = {f"le_{i}": _one(v <= F.lit(float(b))) for i, b in enumerate(bounds)}
    return {**sums, f"le_{len(bounds)}": _one(v.isNotNull())}


def _bucket_rows(wide: DataFrame, keys: Sequence[str], bounds: Sequence[float], count: str) -> DataFrame:
    labels = [bound_label(b) for b in bounds] + [INF]
    rows = F.array(*[F.struct(F.lit(n).alias("le"), F.col(f"le_{i}").alias(count)) for i, n in enumerate(labels)])
    return wide.select(*keys, F.inline(rows))


def le_histogram(df: DataFrame, value: str, bounds: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Cumulative histogram: values at or below each bound, and all of them under ``+Inf``."""
    wide = df.groupBy(*by).agg(*[
        F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in _bucket_sums(value, bounds).items()])
    return _bucket_rows(wide, by, bounds, "cumulative")


def histogram_totals(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Sum and count that go with a histogram."""
    return df.groupBy(*by).agg(F.sum(value).alias("value_sum"), F.count(value).alias("value_count"))


def bucket_increase(log: DataFrame, value: str, bounds: Sequence[float], range: str, step: str,
                    by: Sequence[str] = (), ts: str = "ts") -> DataFrame:
    """How much each cumulative bucket grew over each trailing range."""
    wide = trailing(log, _bucket_sums(value, bounds), range, step, by, ts)
    return _bucket_rows(wide, ["window_start", *by], bounds, "increase")


def histogram_quantiles(hist: DataFrame, quantiles: Sequence[float], by: Sequence[str] = (),
                        cumulative: str = "cumulative") -> DataFrame:
    """Quantiles estimated from cumulative buckets, linear inside a bucket; columns ``p50``, ..

    An empty histogram gives null; a quantile in the ``+Inf`` bucket gives the highest finite
    bound; the first bucket starts at 0, or at its own bound when that is not positive.
    """
    le = F.when(F.col("le") == INF, F.lit(float("inf"))).otherwise(F.col("le").try_cast("double"))
    rows = hist.withColumn("__le", le)
    group = Window.partitionBy(*by)  # a group has one row per bucket bound
    ordered = group.orderBy("__le")
    finite = F.when(F.col("__le") != float("inf"), F.col("__le"))
    rows = rows.select(
        *by, "__le", F.col(cumulative).alias("__cum"),
        F.coalesce(F.lag(cumulative).over(ordered), F.lit(0)).alias("__below"),
        F.lag("__le").over(ordered).alias("__low"),
        F.max(cumulative).over(group).alias("__all"), F.max(finite).over(group).alias("__top"))
    low = F.coalesce("__low", F.lit(0.0))
    width, filled = F.col("__le") - low, F.nullif(F.col("__cum") - F.col("__below"), F.lit(0))
    out = []
    for q in quantiles:
        rank = F.lit(float(q)) * F.col("__all")
        estimate = (F.when(F.col("__le") == float("inf"), F.col("__top"))
                    .when(F.col("__low").isNull() & (F.col("__le") <= 0), F.col("__le"))
                    .otherwise(F.coalesce(low + width * (rank - F.col("__below")) / filled, low)))
        hit = (F.col("__all") > 0) & (F.col("__cum") >= rank)
        out.append(F.min_by(F.when(hit, estimate), F.when(hit, F.col("__le"))).alias(quantile_name(q)))
    return rows.groupBy(*by).agg(*out)


def histogram_quantile(hist: DataFrame, q: float, by: Sequence[str] = (),
                       cumulative: str = "cumulative") -> DataFrame:
    return histogram_quantiles(hist, [q], by, cumulative)


def service_levels(log: DataFrame, range: str, step: str, by: Sequence[str] = (), ts: str = "ts",
                   value: str = "latency_s", status: str = "status", latency_limits: tuple[float, float] = (0.5, 1.0),
                   error_limits: tuple[float, float] = (0.5, 1.0)) -> DataFrame:
    """Mean latency, error percentage and their traffic lights over each trailing range, in one pass."""
    sums = {"n": _one(), "timed": _one(F.col(value).isNotNull()), "latency_sum": F.col(value),
            "errors": _one(F.col(status) >= 400)}
    out = trailing(log, sums, range, step, by, ts).withColumns({
        "avg_latency": F.when(F.col("timed") > 0, F.col("latency_sum") / F.col("timed")),
        "error_pct": 100 * F.col("errors") / F.col("n")})
    return out.withColumns({"latency_band": status_band("avg_latency", *latency_limits),
                            "error_band": status_band("error_pct", *error_limits)}).drop("timed")
