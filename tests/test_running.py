"""Running totals and quantiles against plain Python, with one group holding most rows."""

import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import Window, functions as F

from tidemark.operators.running import _bounds_over_ties, exact_quantiles, number_rows, running_totals, with_range


def skewed(n=3000, seed=1):
    rnd = random.Random(seed)
    groups = ["hot"] * 2 + ["a", "b", None]
    return [(i, rnd.choice(groups), rnd.random() ** 8, rnd.randint(0, 3)) for i in range(n)]


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_by_group(spark, descending):
    rows = skewed()
    df = spark.createDataFrame(rows, "id long, g string, x double, v int").repartition(5)
    got = {r["id"]: (r["v_run"], r["v_all"]) for r in running_totals(
        df, "x", {"v": F.col("v")}, ["g"], descending=descending, ranges=16).collect()}
    want = {}
    for g in {r[1] for r in rows}:
        mine = sorted((r for r in rows if r[1] == g), key=lambda r: r[2], reverse=descending)
        total, run = sum(r[3] for r in mine), 0
        for r in mine:
            run += r[3]
            want[r[0]] = (run, total)
    assert got == want


def test_hot_group_is_cut_into_ranges(spark):
    """All rows in one group: still exact, and no window sorts the whole group."""
    df = spark.range(20000).select("id", F.concat(F.lit("g"), F.col("id") * 0).alias("g"),
                                   F.pow(F.col("id") / 20000, F.lit(6)).alias("x"))
    out = number_rows(df, "x", ["g"])
    assert out.where(F.col("row_number") != F.col("id") + 1).count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "+- Window [" in line and "x#" in line]
    assert windows and all("__range" in line for line in windows)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=60))
def test_exact_quantiles(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    row = exact_quantiles(df, "x", [0.0, 0.25, 0.5, 0.95, 1.0], ranges=8).first()
    want = np.quantile(np.array(values, float), [0.0, 0.25, 0.5, 0.95, 1.0])
    assert np.allclose([row["p0"], row["p25"], row["p50"], row["p95"], row["p100"]], want)
    assert row["n"] == len(values)


def test_quantiles_of_weighted_rows(spark):
    df = spark.createDataFrame([("a", 1.0, 3), ("a", 9.0, 1), ("b", 5.0, 2), ("b", None, 7)], "g string, x double, n int")
    got = {r["g"]: (r["n"], r["p50"]) for r in exact_quantiles(df, "x", [0.5], ["g"], "n").collect()}
    assert got == {"a": (4, 1.0), "b": (2, 5.0)}


@pytest.mark.parametrize("ties", ["one value", "few values"])
def test_ties_are_cut_by_the_tiebreak(spark, ties):
    """A bulk load with one time: numbered by the tiebreak, and no range holds above twice the median."""
    x = F.lit(7) if ties == "one value" else F.when(F.col("id") < 90000, 7).otherwise((F.col("id") % 5).cast("int"))
    df = spark.range(100000).select(F.lit("m").alias("g"), x.alias("x"),
                                    F.concat(F.lit("run-"), F.lpad((F.col("id") * 7919 % 100003).cast("string"), 6, "0")).alias("t"))
    out = number_rows(df, "x", ["g"], tiebreak=("t",))
    plain = df.withColumn("want", F.row_number().over(Window.partitionBy("g").orderBy("x", "t")))
    both = out.join(plain, ["g", "x", "t"])
    assert both.count() == 100000 and both.where("want <> row_number").isEmpty()
    key = F.struct("x", "t")
    sizes = sorted(r["count"] for r in with_range(df.withColumn("__bounds", _bounds_over_ties(df, key, 64)), key, 63)
                   .groupBy("__range").count().collect())
    assert len(sizes) == 64 and sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_ties_of_null_tiebreaks_and_of_nothing(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 1, "b"), ("a", 0, "z"), (None, 1, "a")], "g string, x int, t string")
    got = {(r["g"], r["x"], r["t"]): r["row_number"] for r in number_rows(df, "x", ["g"], tiebreak=("t",)).collect()}
    assert got == {("a", 0, "z"): 1, ("a", 1, None): 2, ("a", 1, "b"): 3, (None, 1, "a"): 1}
    assert number_rows(df.where("x > 5"), "x", ["g"], tiebreak=("t",)).isEmpty()
