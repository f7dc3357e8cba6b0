"""Streams against the batch jobs: same results, late rows, restarts."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tests.test_clean_validate import request
from tidemark.operators import monitor as mon, scoring as s, training as tr, validate as v
from tidemark.plans.views import customers
from tidemark.sources.tables import explode_batch
from tidemark.spec import CUSTOMER, CUSTOMER_FIELDS, request_schema
from tidemark.streaming import live

LOG = "ts timestamp, handler string, latency_s double"
NOON = dt.datetime(2024, 1, 1, 12)


def drop_in(spark, folder, number, rows):
    """One parquet file whose age follows its number."""
    part = os.path.join(folder, f"part-{number}")
    spark.createDataFrame(rows, LOG).coalesce(1).write.parquet(part)
    for name in os.listdir(part):
        os.utime(os.path.join(part, name), (1_700_000_000 + number, 1_700_000_000 + number))


def log_stream(spark, folder):
    schema = spark.createDataFrame([], LOG).schema
    return live.read_stream(spark, f"{folder}/*", schema, files_per_batch=1)


def test_scores_equal_batch(spark, valid_row, tmp_path):
    rows = request(spark, valid_row, {**valid_row, "tenure": 80}, {**valid_row, "Contract": "Two year"}, text=True)
    rows.write.json(f"{tmp_path}/in")
    wanted = s.score_batch(v.typed(v.validate(rows)), key="gender").drop("errors")
    stream = live.score_stream(live.read_stream(spark, f"{tmp_path}/in", request_schema(text=True), "json"), key="gender")
    live.append_to(stream.drop("errors"), f"{tmp_path}/out", f"{tmp_path}/mark").awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out").select(*wanted.columns)
    assert got.count() == 3 and got.exceptAll(wanted).isEmpty()


def test_large_batches_on_a_stream(spark, valid_row, tmp_path):
    """Arrays of 4 and 3 rows and none at all, with at most 3 allowed."""
    one = request(spark, valid_row, text=True)
    struct = F.struct(*one.columns)
    lists = [one.select(F.lit(name).alias("batch_id"), F.array_repeat(struct, n).alias("customers")) for name, n in (("a", 4), ("b", 3), ("c", 0))]
    lists[0].union(lists[1]).union(lists[2]).write.json(f"{tmp_path}/in")
    stream = live.read_stream(spark, f"{tmp_path}/in", lists[0].schema, "json")
    rows = explode_batch(stream, size="batch_rows")
    live.append_to(live.score_stream(rows, size="batch_rows", max_batch=3), f"{tmp_path}/out", f"{tmp_path}/mark").awaitTermination()
    out = spark.read.parquet(f"{tmp_path}/out")
    got = {(r["batch_id"], r["status"]): r["n"] for r in out.groupBy("batch_id", "status").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {("a", "invalid"): 4, ("b", "valid"): 3, ("c", "invalid"): 1}
    assert {r["detail"] for r in out.where("batch_id = 'a'").collect()} == {"batch: 4 rows, at most 3 allowed"}


def test_rows_behind_the_watermark_are_dropped(spark, tmp_path):
    folder = str(tmp_path / "in")
    drop_in(spark, folder, 1, [(NOON, "a", 1.0)] * 3)
    drop_in(spark, folder, 2, [(NOON + dt.timedelta(hours=6), "a", 1.0)])
    drop_in(spark, folder, 3, [(NOON + dt.timedelta(hours=6), "a", 1.0)])
    # The watermark applies to late rows one batch after it has moved.
    drop_in(spark, folder, 4, [(NOON, "a", 1.0), (NOON + dt.timedelta(hours=6), "a", 2.0)])
    updates = live.stream_rate(log_stream(spark, folder), ["handler"], "1 hour", "1 hour", "1 hour")
    live.update_to(updates, f"{tmp_path}/out", f"{tmp_path}/mark").awaitTermination()
    now = live.latest(spark.read.parquet(f"{tmp_path}/out"), ["window_start", "handler"])
    assert {(r["window_start"].hour, r["n"]) for r in now.collect()} == {(12, 3), (18, 3)}


def test_restart_counts_nothing_twice(spark, tmp_path):
    folder = str(tmp_path / "in")
    drop_in(spark, folder, 1, [(NOON, "a", 1.0), (NOON, "b", 1.0)])

    def run():
        updates = live.stream_counts(log_stream(spark, folder), ["handler"])
        live.update_to(updates, f"{tmp_path}/out", f"{tmp_path}/mark").awaitTermination()
        return {r["handler"]: r["n"] for r in live.latest(spark.read.parquet(f"{tmp_path}/out"), ["handler"]).collect()}

    assert run() == {"a": 1, "b": 1} and run() == {"a": 1, "b": 1}
    drop_in(spark, folder, 2, [(NOON, "a", 1.0)])
    assert run() == {"a": 2, "b": 1}


@pytest.mark.parametrize("range, step", [("2 hours", "1 hour"), ("1 hour", "1 hour")])
def test_rates_equal_batch(spark, tmp_path, range, step):
    rows = [(NOON + dt.timedelta(minutes=7 * i), "ab"[i % 2], 0.1 * i) for i in __builtins__["range"](60)]
    folder = str(tmp_path / "in")
    drop_in(spark, folder, 1, rows)
    updates = live.stream_rate(log_stream(spark, folder), ["handler"], range, step, "1 hour")
    live.update_to(updates, f"{tmp_path}/out", f"{tmp_path}/mark").awaitTermination()
    got = live.latest(spark.read.parquet(f"{tmp_path}/out"), ["window_start", "handler"])
    wanted = mon.rate(spark.createDataFrame(rows, LOG), ["handler"], range, step)
    names = ["window_start", "handler", "n", "per_second"]
    assert got.select(names).exceptAll(wanted.select(names)).isEmpty() and got.count() == wanted.count()


def test_stream_scored_by_a_fitted_model(spark, sf, valid_row, tmp_path):
    train = customers(spark, sf).where("TotalCharges IS NOT NULL")
    model = tr.fit_once(train, CUSTOMER, tr.algorithms(max_iter=5)["lr"])
    rows = request(spark, valid_row, {**valid_row, "tenure": 80}, text=True)
    rows.write.json(f"{tmp_path}/in")
    stream = live.read_stream(spark, f"{tmp_path}/in", request_schema(text=True), "json")
    live.append_to(live.score_stream(stream, version="3", key="tenure", model=model).drop("errors"),
                   f"{tmp_path}/out", f"{tmp_path}/mark").awaitTermination()
    numeric = [f.name for f in CUSTOMER_FIELDS if f.type != "string"]
    wanted = {r["status"]: r["churn_probability"] for r in
              s.score_with_model(v.typed(v.validate(rows)), model, numeric, "3", "tenure").collect()}
    got = {r["status"]: r["churn_probability"] for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == wanted and got["valid"] is not None and got["invalid"] is None


def _traffic(n=300, seconds=40):
    import random
    rnd = random.Random(4)
    return [(NOON + dt.timedelta(seconds=seconds * i), rnd.choice(["a", "b", None]), rnd.choice([None, rnd.random(), 0.5, 2.0]))
            for i in range(n)]


def _rows(frame, names):
    return sorted((tuple(r) for r in frame.select(*names).collect()), key=repr)


def test_panes_hold_one_row_of_state_and_give_the_batch_ranges(spark, tmp_path):
    """At 5 minutes / 15 seconds an event used to enter 20 windows; now it enters one pane."""
    rows = _traffic()
    folder = str(tmp_path / "in")
    drop_in(spark, folder, 1, rows)
    panes = live.stream_panes(log_stream(spark, folder), ["handler"], "15 seconds", "1 hour")
    query = live.update_to(panes, f"{tmp_path}/out", f"{tmp_path}/mark")
    query.awaitTermination()
    kept = sum(p["stateOperators"][0]["numRowsUpdated"] for p in query.recentProgress)
    assert kept == len({(int((t - NOON).total_seconds()) // 15, h) for t, h, _ in rows}) <= len(rows)
    now = live.latest(spark.read.parquet(f"{tmp_path}/out"), ["__slot", "handler"])
    names = ["window_start", "handler", "n", "per_second"]
    want = mon.rate(spark.createDataFrame(rows, LOG), ["handler"], "5 minutes", "15 seconds")
    assert _rows(live.ranges_of_panes(now, "5 minutes", "15 seconds", ["handler"]), names) == _rows(want, names)


def test_ranges_are_appended_once_the_watermark_has_passed(spark, tmp_path):
    rows = _traffic()
    folder = str(tmp_path / "in")
    drop_in(spark, folder, 1, rows)
    later = NOON + dt.timedelta(days=2)
    drop_in(spark, folder, 2, [(later, "a", 1.0)])
    drop_in(spark, folder, 3, [(later, "a", 1.0)])
    stream = live.stream_ranges(log_stream(spark, folder), ["handler"], "5 minutes", "1 minute", "1 minute", value="latency_s",
                                quantiles=(0.5,))
    query = live.append_to(stream, f"{tmp_path}/out", f"{tmp_path}/mark")
    query.awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out")
    names = ["window_start", "handler", "n"]
    want = mon.rate(spark.createDataFrame(rows, LOG), ["handler"], "5 minutes", "1 minute")
    assert _rows(got, names) == _rows(want, names)
    exact = mon.latency_quantiles(spark.createDataFrame(rows, LOG), (0.5,), "5 minutes", "1 minute", ["handler"], exact=False)
    assert _rows(got.where("p50 IS NOT NULL"), ["window_start", "handler"]) == _rows(exact.where("p50 IS NOT NULL"), ["window_start", "handler"])


def test_streamed_quantiles_stay_within_the_rank_error(spark, tmp_path):
    import random
    rnd = random.Random(9)
    rows = [(NOON + dt.timedelta(seconds=i // 40), "a", rnd.lognormvariate(0, 2)) for i in range(40_000)]
    folder = str(tmp_path / "in")
    drop_in(spark, folder, 1, rows)
    panes = live.stream_panes(log_stream(spark, folder), [], "1 minute", "1 hour", value="latency_s")
    live.update_to(panes, f"{tmp_path}/out", f"{tmp_path}/mark").awaitTermination()
    now = live.latest(spark.read.parquet(f"{tmp_path}/out"), ["__slot"])
    for r in live.ranges_of_panes(now, "5 minutes", "1 minute", (), (0.5, 0.95)).collect():
        start = r["window_start"]
        mine = [v for t, _, v in rows if start <= t < start + dt.timedelta(minutes=5)]
        assert r["n"] == len(mine)
        for q, value in ((0.5, r["p50"]), (0.95, r["p95"])):
            assert abs(sum(v <= value for v in mine) / len(mine) - q) < 0.03


def test_snapshots_bound_what_is_read(spark, tmp_path):
    """Files do not grow with the number of batches, and a replayed batch changes nothing."""
    folder, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    schema = spark.createDataFrame([], "handler string, n long").schema
    want = {}
    for number in range(13):
        names = ["a", "b", None, f"h{number % 4}"]
        drop_in(spark, folder, number, [(NOON, h, 1.0) for h in names])
        for h in names:
            want[h] = want.get(h, 0) + 1

    def run():
        counts = live.stream_counts(log_stream(spark, folder), ["handler"])
        live.snapshot_to(counts, out, mark, ["handler"], every=3).awaitTermination()
        return {r["handler"]: r["n"] for r in live.read_latest(spark, out, schema, ["handler"]).collect()}

    assert run() == want
    assert len(os.listdir(f"{out}/batches")) <= 2 * 3 + 1 and len(os.listdir(f"{out}/snapshots")) == 2
    last = max(int(n.partition("=")[2]) for n in os.listdir(f"{out}/snapshots"))
    for name in os.listdir(f"{mark}/commits"):  # the batch of the last snapshot, and all after it, are played again
        if name.lstrip(".").split(".")[0].isdigit() and int(name.lstrip(".").split(".")[0]) >= last:
            os.remove(f"{mark}/commits/{name}")
    assert run() == want


def test_nothing_to_read_is_an_empty_table(spark, tmp_path):
    schema = spark.createDataFrame([], "handler string, n long").schema
    assert live.read_latest(spark, str(tmp_path / "none"), schema, ["handler"]).count() == 0
