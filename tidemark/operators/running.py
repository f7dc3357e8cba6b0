"""Running totals and exact quantiles that never put a whole group into one task.

A window without, or with a very hot, partition key sorts all its rows in one task.
Here the order column is cut into ranges at approximate quantiles. Each range gets its own
window, which starts with one extra row carrying the totals of the ranges before it (four rows
per shuffle partition and group). The result is exact whatever the quantiles are. Where a
tiebreak is given the ranges are cut on (order, tiebreak), so a bulk load whose rows all have
one time is cut as well.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def _default_ranges(df: DataFrame) -> int:
    """A few ranges per shuffle task, so that ranges shrink as a larger input gets more tasks."""
    return max(64, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def exact_total(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


#: Sampled rows per range, on average, from which bounds over (order, tiebreak) are taken.
SAMPLED = 40


def _bounds_over_ties(df: DataFrame, key: Column, ranges: int) -> Column:
    """Bounds of ranges over a struct: every n-th of a sorted sample of about ``SAMPLED`` rows a range. The sample is
    drawn by hash, so that a task run again draws the same rows."""
    every = df.agg(F.greatest(F.lit(1), F.floor(F.count(F.lit(1)) / (SAMPLED * ranges)))).scalar()
    drawn = df.where(F.pmod(F.xxhash64(key, F.lit("bounds")), every) == 0).agg(F.array_sort(F.collect_set(key)).alias("all"))
    places = F.sequence(F.lit(1), F.lit(ranges - 1))
    return drawn.select(F.transform(places, lambda i: F.get(
        "all", F.floor(i * F.size("all") / ranges).cast("int")))).scalar()


def with_range(df: DataFrame, order: str | Column, size: int) -> DataFrame:
    """Add how many of the sorted ``__bounds`` lie below ``order``, by halving: each step is a
    projection that stays in generated code."""
    order = F.col(order) if isinstance(order, str) else order
    out = df.withColumn("__range", F.lit(0))
    low = F.col("__range")
    for step in (1 << p for p in range(size.bit_length() - 1, -1, -1)):
        bound = F.get("__bounds", low + (step - 1))
        out = out.withColumn("__range", F.when(bound < order, low + step).otherwise(low))
    return out.drop("__bounds")


def running_totals(df: DataFrame, order: str, totals: Mapping[str, Column], by: Sequence[str] = (),
                   descending: bool = False, tiebreak: Sequence[str] = (),
                   ranges: int | None = None) -> DataFrame:
    """For each ``name: column`` of ``totals`` append ``name_run`` (sum over the rows of the
    group up to this one in ``order``) and ``name_all`` (sum over the whole group).

    ``order`` is a number, date or timestamp without nulls. Equal values come in the order of the
    ``tiebreak`` columns (ascending, nulls first). Without a tiebreak, and when ``descending``, they stay in one
    range, so group them first. Rows of ``by`` with null keys form their own group.

    The input is read by three branches (four with a tiebreak): the quantiles, the totals per range, and the rows.
    They use the same columns, so an input that ends in a ``groupBy`` is shuffled only once.
    """
    by = list(by)
    ranges = ranges or _default_ranges(df)
    cuts = [i / ranges for i in range(1, ranges)]
    if tiebreak and not descending:
        key = F.struct(order, *tiebreak)
        bounds = _bounds_over_ties(df, key, ranges)
    else:
        key = F.col(order)
        bounds = df.agg(F.struct(F.percentile_approx(order, cuts, 10 * ranges).alias("bounds"),
                                 *[F.sum(c) for c in totals.values()])).scalar()["bounds"]
    work = with_range(df.withColumn("__bounds", bounds), key, len(cuts)).withColumns(
        {f"__{n}": c for n, c in totals.items()})

    per_range = work.groupBy(*by, "__range").agg(*[F.sum(f"__{n}").alias(f"__{n}") for n in totals])
    group = Window.partitionBy(*by)
    earlier = (group.orderBy(F.col("__range").desc() if descending else F.col("__range").asc())
               .rowsBetween(Window.unboundedPreceding, -1))
    carried = per_range.select(
        *by, "__range", F.lit(0).alias("__kind"),
        *[F.coalesce(F.sum(f"__{n}").over(earlier), F.lit(0)).alias(f"__{n}") for n in totals],
        *[F.sum(f"__{n}").over(group).alias(f"__{n}_all") for n in totals])

    rows = work.withColumn("__kind", F.lit(1)).unionByName(carried, allowMissingColumns=True)
    order_by = F.col(order).desc() if descending else F.col(order).asc()
    within = (Window.partitionBy(*by, "__range").orderBy("__kind", order_by, *tiebreak)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return rows.select(
        *df.columns, "__kind",
        *[F.sum(f"__{n}").over(within).alias(f"{n}_run") for n in totals],
        *[F.first(f"__{n}_all").over(within).alias(f"{n}_all") for n in totals],
    ).where(F.col("__kind") == 1).drop("__kind")


def exact_quantiles(df: DataFrame, value: str, quantiles: Sequence[float], by: Sequence[str] = (),
                    weight: str | None = None, ranges: int | None = None) -> DataFrame:
    """Exact quantiles per group with linear interpolation; columns ``p50``, ``p95``, ..

    Equal values are counted before the shuffle; ``weight`` names a column that already
    holds such counts. Null values are ignored.
    """
    by = list(by)
    count = F.sum(weight) if weight else F.count(F.lit(1))
    present = df.where(F.col(value).isNotNull())
    counted = present.groupBy(*by, value).agg(count.alias("__n"))
    ranked = running_totals(counted, value, {"n": F.col("__n")}, by, ranges=ranges)
    out = []
    for q in quantiles:
        place = F.lit(float(q)) * (F.col("n_all") - 1)
        low, high = F.floor(place), F.ceil(place)

        def at(index: Column) -> Column:
            here = (F.col("n_run") - F.col("__n") <= index) & (index < F.col("n_run"))
            return F.max(F.when(here, F.col(value)))

        share = F.max(place - low)
        out.append((at(low) * (1 - share) + at(high) * share).alias(quantile_name(q)))
    return ranked.groupBy(*by).agg(F.max("n_all").alias("n"), *out)


def quantile_name(q: float) -> str:
    return f"p{q * 100:g}".replace(".", "_")


def number_rows(df: DataFrame, order: str, by: Sequence[str] = (), name: str = "row_number",
                tiebreak: Sequence[str] = ()) -> DataFrame:
    """Row number within each group, without one task per group; one order value may be that of all rows
    if a ``tiebreak`` is given."""
    out = running_totals(df, order, {"__row": F.lit(1)}, by, tiebreak=tiebreak)
    return out.withColumn(name, F.col("__row_run")).drop("__row_run", "__row_all")
