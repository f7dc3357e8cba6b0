"""Registry invariants, run tables, histograms and rates."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import monitor as mon, registry as reg, runs

T0 = dt.datetime(2024, 1, 1)


def at(day):
    return F.lit(T0 + dt.timedelta(days=day)).cast("timestamp")


@pytest.fixture
def setup(spark):
    rows = [("m", "r1", 0.85, 1), ("m", "r2", 0.79, 2), ("m", "r3", 0.90, 3), ("n", "r4", 0.5, 1)]
    table = spark.createDataFrame(rows, "name string, run_id string, auc_roc double, day int")
    table = table.withColumn("created_at", F.timestamp_seconds(F.col("day") * 86400))
    none = spark.createDataFrame([], reg.VERSIONS)
    versions = reg.register_versions(table.select("name", "run_id", "created_at").withColumns(
        {"source": F.lit(""), "description": F.lit("")}), none)
    return versions, reg.registration_events(versions), table.select("run_id", "auc_roc")


def stages(events):
    return {(r["name"], r["version"]): r["stage"] for r in reg.current_stages(events).collect()}


def version(spark, name, n):
    return spark.createDataFrame([(name, n)], "name string, version int")


def test_life_of_a_model(spark, setup):
    versions, events, table = setup
    assert {(r["name"], r["version"], r["run_id"]) for r in versions.collect()} == {
        ("m", 1, "r1"), ("m", 2, "r2"), ("m", 3, "r3"), ("n", 1, "r4")}
    assert set(stages(events).values()) == {"Staging"}

    for day, n in ((10, 1), (11, 2), (12, 3)):
        events = events.unionByName(reg.promote(versions, events, table, at(day), targets=version(spark, "m", n)))
        assert all(r["in_production"] <= 1 for r in reg.production_counts(events).collect())
    assert stages(events) == {("m", 1): "Archived", ("m", 2): "Staging", ("m", 3): "Production", ("n", 1): "Staging"}

    events = events.unionByName(reg.rollback(events, at(13)))
    assert stages(events)[("m", 1)] == "Production" and stages(events)[("m", 3)] == "Archived"


def test_gate_and_force(setup):
    versions, events, table = setup
    decided = {r["name"]: r["passed"] for r in reg.promotion_decisions(versions, events, table).collect()}
    assert decided == {"m": True, "n": False}
    forced = reg.promote(versions, events, table, at(5), force=True)
    assert {r["name"] for r in forced.where(F.col("stage") == "Production").collect()} == {"m", "n"}


def test_unknown_stage_is_an_error(setup):
    with pytest.raises(ValueError):
        reg.stage_events(setup[0], "Live", at(1))


def test_registering_twice_adds_nothing(spark):
    names = spark.createDataFrame([("a",), ("a",), ("b",)], "name string")
    first = reg.ensure_models(spark.createDataFrame([], "name string"), names)
    assert first.count() == 2 and reg.ensure_models(first, names).count() == 0
    ex = runs.ensure_experiments(spark.createDataFrame([], "name string, experiment_id string"), names)
    assert runs.ensure_experiments(ex, names).count() == 0


def test_missing_duration_gets_no_vote_unless_asked(spark):
    rows = [("m", 1, 0.9, 0.8, 0.8, 0.8, 0.8, 10.0), ("m", 2, 0.9, 0.9, 0.7, 0.8, 0.8, None)]
    df = spark.createDataFrame(rows, "name string, version int, auc_roc double, accuracy double, precision double, "
                                     "recall double, f1_score double, training_duration_seconds double")

    def verdict(missing):
        c = reg.compare_versions(df, 1, 2, missing)
        return {r["metric"]: r["winner"] for r in c.collect()}, reg.comparison_verdict(c, 1, 2).first()

    votes, row = verdict("no_vote")
    assert votes["training_duration_seconds"] == "no_vote" and votes["auc_roc"] == "tie"
    assert (row["score"], row["winner_version"]) == ("1-1", None)
    votes, row = verdict("zero")
    assert votes["training_duration_seconds"] == "v2" and row["winner_version"] == 2


def test_champion_takes_the_first_of_a_tie(spark):
    df = spark.createDataFrame([("a", 1.0, 2), ("b", 1.0, 1), ("c", None, 0)], "run_id string, auc_roc double, logged_order int")
    assert runs.champion(df).first()["run_id"] == "b"


def test_long_params_are_stored_whole(spark):
    df = spark.createDataFrame([("r", "param_grid", "x" * 900)], runs.PARAMS)
    assert runs.log_params(df).first()["value"] == "x" * 900


def test_description_text(spark):
    df = spark.createDataFrame([("GBT", 0.852643, 0.8, 0.79, 61.487)], "a string, b double, c double, d double, e double")
    text = df.select(runs.describe_run(*[F.col(c) for c in "abcde"])).first()[0]
    assert text == "best run by AUC, GBT; auc 0.8526; accuracy 0.8000; f1 0.7900; fitted in 61.5 seconds"


# --- monitoring -----------------------------------------------------------------------------------

def test_histogram_is_cumulative(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (0.55,), (1.0,), (None,)], "x double")
    rows = {r["le"]: r["cumulative"] for r in mon.le_histogram(df, "x", (0.0, 0.1, 0.5, 1.0)).collect()}
    assert rows == {"0.0": 1, "0.1": 2, "0.5": 2, "1.0": 4, "+Inf": 4}


@pytest.mark.parametrize("cum, q, want", [
    ((0, 0, 0), 0.5, None),          # empty
    ((0, 10, 10), 0.5, 7.5),         # half way from 5 to 10
    ((10, 10, 10), 0.5, 2.5),        # the first bucket starts at 0
    ((0, 0, 10), 0.95, 10.0),        # beyond the last finite bound
])
def test_histogram_quantile(spark, cum, q, want):
    df = spark.createDataFrame(list(zip(("5.0", "10.0", "+Inf"), cum)), "le string, cumulative long")
    assert mon.histogram_quantile(df, q).first()[0] == want


def test_first_bound_not_positive(spark):
    df = spark.createDataFrame([("0.0", 9), ("1.0", 10), ("+Inf", 10)], "le string, cumulative long")
    assert mon.histogram_quantile(df, 0.5).first()[0] == 0.0


def test_trailing_ranges_equal_sliding_windows(spark, sf):
    log = spark.read.parquet(f"{sf}/events.parquet")
    mine = mon.rate(log, ["event_type"], "6 hours", "2 hours").select("window_start", "event_type", "n")
    spark_way = log.groupBy(F.window("ts", "6 hours", "2 hours").start.alias("window_start"), "event_type").agg(
        F.count(F.lit(1)).alias("n"))
    assert mine.exceptAll(spark_way).isEmpty() and spark_way.exceptAll(mine).isEmpty()


def test_no_traffic_is_zero_errors(spark):
    df = spark.createDataFrame([], "status int")
    assert mon.total_error_rate(df).first()["error_pct"] == 0.0


def test_range_must_fit_steps(spark, sf):
    with pytest.raises(ValueError):
        mon.rate(spark.read.parquet(f"{sf}/events.parquet"), [], "1 minute", "25 seconds")


def test_selected_quantiles_are_exact(spark):
    """Also with ties, null values and keys, one row a range, and a value that a third of the rows have."""
    import datetime as dt
    import random
    import statistics
    rnd = random.Random(8)
    at = dt.datetime(2024, 1, 1)
    rows = [(at + dt.timedelta(seconds=rnd.randrange(1200)), rnd.choice(["a", "b", None]),
             rnd.choice([None, 1.5, round(rnd.random(), 2), rnd.lognormvariate(0, 3)])) for _ in range(900)]
    rows += [(at + dt.timedelta(hours=5), "a", 3.0), (at + dt.timedelta(hours=6), "a", None)]
    log = spark.createDataFrame(rows, "ts timestamp, handler string, latency_s double")
    want = {}
    for t, h, v in rows:
        if v is not None:
            slot = int((t - at).total_seconds()) // 60
            for k in range(5):
                want.setdefault((slot - k, h), []).append(v)

    def quantile(values, q):
        values = sorted(values)
        place = q * (len(values) - 1)
        low = int(place)
        high = min(low + 1, len(values) - 1)
        return values[low] * (1 - (place - low)) + values[high] * (place - low)

    for buckets in (2, 7, 256):
        got = mon.selected_quantiles(log, "latency_s", (0.0, 0.5, 0.95, 1.0), "5 minutes", "1 minute", ["handler"], buckets=buckets)
        found = {(round((r["window_start"] - at).total_seconds()) // 60, r["handler"]): r for r in got.collect()}
        assert set(found) == set(want)
        for key, values in want.items():
            r = found[key]
            assert r["n"] == len(values)
            for q, name in ((0.0, "p0"), (0.5, "p50"), (0.95, "p95"), (1.0, "p100")):
                assert r[name] == pytest.approx(quantile(values, q), rel=1e-12)
            assert r["p50"] == pytest.approx(statistics.median(values), rel=1e-12)
    assert mon.latency_quantiles(log.limit(0), by=["handler"]).count() == 0


def test_selection_moves_less_than_two_copies_of_the_log(spark):
    """Rows of the shuffles of one run, counted by Spark: the joined side and the selected values."""
    log = spark.range(60_000).selectExpr("timestamp_seconds(1704067200 + id div 50) AS ts", "rand(3) * 10 AS latency_s")
    log = log.checkpoint()
    moved = mon.latency_quantiles(log, (0.5, 0.95), "5 minutes", "15 seconds")
    got = moved.collect()
    written = 0
    stack = [moved._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            stack.append(node.executedPlan())
            continue
        if "QueryStage" in name:
            stack.append(node.plan())
            continue
        if name == "Exchange":
            written += node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        stack.extend(children.apply(i) for i in range(children.size()))
    assert len(got) > 80 and 0 < written < 2 * 60_000


def test_silent_ranges_are_zero(spark):
    rows = [("2024-01-01 00:00:10", "a", 200), ("2024-01-01 00:03:10", "a", 500), ("2024-01-01 00:01:00", None, 500)]
    log = spark.createDataFrame(rows, "ts string, handler string, status int").withColumn("ts", F.col("ts").cast("timestamp"))
    out = mon.error_rate(log, "1 minute", "1 minute", ["handler"], silent=True)
    got = sorted(((r["handler"] or "", r["window_start"].minute, r["n"], r["errors"], r["error_pct"]) for r in out.collect()))
    assert got == [("", 1, 1, 1, 100.0), ("a", 0, 1, 0, 0.0), ("a", 1, 0, 0, 0.0), ("a", 2, 0, 0, 0.0), ("a", 3, 1, 1, 100.0)]
    whole = mon.rate(log, range="2 minutes", step="1 minute", silent=True).orderBy("window_start").collect()
    assert [r["n"] for r in whole] == [1, 2, 1, 1, 1] and whole[0]["per_second"] == 1 / 120
    mean = mon.avg_latency(log.withColumn("latency_s", F.lit(2.0)), "1 minute", "1 minute", ["handler"], silent=True)
    assert [(r["n"], r["avg_latency"]) for r in mean.where("handler = 'a'").orderBy("window_start").collect()] == [
        (1, 2.0), (0, None), (0, None), (1, 2.0)]
    assert mon.error_rate(log.limit(0), "1 minute", "1 minute", silent=True).count() == 0
