"""Cleaning, validation, profiling and splits on small literal tables."""

import pytest
from pyspark.sql import functions as F, types as T

from tidemark.operators import clean, profile, split, validate as v
from tidemark.sources import tables as src
from tidemark.spec import CUSTOMER, CUSTOMER_FIELDS, raw_customer_schema, request_schema

RAW = [("1", " ", "Yes"), ("2", "", "No"), ("3", "abc", "No"), ("4", None, "Yes"), ("5", "12.5", None),
       ("6", "12.5", "Maybe"), ("7", "3", "No")]


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(RAW, "customerID string, TotalCharges string, Churn string")


def test_repair_and_label_filter(raw):
    rows = {r["customerID"]: r["TotalCharges"] for r in clean.clean_customers(raw, drop=()).collect()}
    assert rows == {"1": 0.0, "2": 0.0, "3": None, "4": None, "7": 3.0}
    assert clean.clean_customers(raw).columns == ["TotalCharges", "Churn"]


def test_unparsed_text_goes_to_quarantine(raw):
    assert [r["reason"] for r in clean.unparsed(raw, "TotalCharges").collect()] == ["TotalCharges: not a number: abc"]


def test_load_report(raw):
    row = src.load_report(raw, clean.valid_label("Churn", ("Yes", "No"))).first()
    assert (row["rows_read"], row["rows_kept"], row["rows_dropped"], row["columns_read"]) == (7, 5, 2, 3)


def test_blank_total_survives_the_csv_reader(spark, tmp_path, valid_row):
    header = ["customerID", *[f.name for f in CUSTOMER_FIELDS], "Churn"]
    line = ["c1", *[str(valid_row[f.name]) for f in CUSTOMER_FIELDS], "No"]
    line[header.index("TotalCharges")] = " "
    path = tmp_path / "raw.csv"
    path.write_text(",".join(header) + "\n" + ",".join(line) + "\n")
    df = src.read_table(spark, str(path), raw_customer_schema())
    assert df.first()["TotalCharges"] == " " and len(df.columns) == 21
    assert clean.clean_customers(df).first()["TotalCharges"] == 0.0


def request(spark, *rows, text=False):
    names = [f.name for f in CUSTOMER_FIELDS]
    data = [tuple(None if r.get(n) is None else (str(r[n]) if text else r[n]) for n in names) for r in rows]
    return spark.createDataFrame(data, request_schema(text=text))


def test_valid_row_passes(spark, valid_row):
    for text in (False, True):
        row = v.validate(request(spark, valid_row, text=text)).first()
        assert (row["status"], row["detail"], row["errors"]) == ("valid", "", [])


@pytest.mark.parametrize("change, detail", [
    ({"gender": None}, "gender: Field required"),
    ({"gender": "Unknown"}, "gender: Input should be 'Male' or 'Female'"),
    ({"tenure": -2}, "tenure: Input should be greater than or equal to 0"),
    ({"tenure": 73}, "tenure: Input should be less than or equal to 72"),
    ({"PaymentMethod": "Barter"}, "PaymentMethod: Input should be 'Electronic check', 'Mailed check', "
                                   "'Bank transfer (automatic)' or 'Credit card (automatic)'"),
    ({"MonthlyCharges": 0.0}, "MonthlyCharges: Input should be greater than 0"),
    ({"SeniorCitizen": 2}, "SeniorCitizen: Input should be 0 or 1"),
])
def test_rejected_rows_name_the_field(spark, valid_row, change, detail):
    row = v.validate(request(spark, {**valid_row, **change})).first()
    assert (row["status"], row["detail"]) == ("invalid", detail)


def test_all_errors_are_collected(spark, valid_row):
    bad = {**valid_row, "gender": None, "tenure": "x", "MonthlyCharges": "-1"}
    detail = v.validate(request(spark, bad, text=True)).first()["detail"]
    assert detail.split("; ") == ["gender: Field required", "tenure: Input should be a valid integer",
                                  "MonthlyCharges: Input should be greater than 0"]


def test_split_valid_keeps_every_row_once(spark, valid_row):
    rows = v.validate(request(spark, valid_row, {**valid_row, "tenure": 99}, valid_row))
    ok, bad = v.split_valid(rows)
    assert (ok.count(), bad.count()) == (2, 1) and "status" not in ok.columns


@pytest.mark.parametrize("size, accepted", [(0, False), (1, True), (1000, True), (1001, False)])
def test_list_size_limits(spark, size, accepted):
    df = spark.range(1).select(F.slice(F.array_repeat(F.lit("x"), 1001), 1, size).alias("customers"))
    row = v.check_list_sizes(df, "customers").first()
    assert (row["batch_size"], row["accepted"]) == (size, accepted)


def test_missing_list_is_rejected(spark):
    df = spark.createDataFrame([(None,)], "customers array<string>")
    assert v.check_list_sizes(df, "customers").first()["accepted"] is False


def test_gate_includes_the_threshold(spark):
    df = spark.createDataFrame([(0.8,), (0.7999,), (None,)], "auc_roc double")
    assert [r["passed"] for r in v.gate(df, "auc_roc").collect()] == [True, False, False]


def test_missing_counts_by_type(spark):
    df = spark.createDataFrame([("", 0), (None, None), ("x", 1)], "s string, n int")
    assert {r["column_name"]: r["missing"] for r in profile.missing_counts(df).collect()} == {"s": 2, "n": 1}


def test_class_distribution(spark):
    df = spark.createDataFrame([("No",)] * 2 + [("Yes",)], "Churn string")
    rows = {r["Churn"]: (r["count"], r["percentage"]) for r in profile.class_distribution(df, "Churn").collect()}
    assert rows == {"No": (2, 66.67), "Yes": (1, 33.33)}


def test_exploration_summary_sections(spark, sf):
    from tidemark.plans.views import customers
    rows = profile.exploration_summary(customers(spark, sf).drop("customerID"), CUSTOMER).collect()
    assert {r["section"] for r in rows} == {"total", "class", "missing", "columns"}
    assert [r["value"] for r in rows if r["name"] == "columns"] == ["20"]


def test_split_ignores_partitioning(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    sides = [{r["k"] for r in split.split(df.repartition(n), key="k")[0].collect()} for n in (1, 7)]
    assert sides[0] == sides[1] and 0.76 < len(sides[0]) / 2000 < 0.84
    train, test = split.split(df, key="k")
    assert train.intersect(test).count() == 0 and train.count() + test.count() == 2000


def test_folds_are_disjoint_and_complete(spark):
    rows = split.with_folds(spark.range(900), "id", 3).groupBy("fold").count().collect()
    assert sorted(r["fold"] for r in rows) == [0, 1, 2] and sum(r["count"] for r in rows) == 900


def test_sample_is_reproducible(spark):
    df = spark.range(1000)
    a = {r["id"] for r in split.sample_n(df.repartition(3), 50, "id").collect()}
    b = {r["id"] for r in split.sample_n(df.repartition(8), 50, "id").collect()}
    assert a == b and len(a) == 50


def test_cached_releases(spark):
    with split.cached(spark.range(10)) as (df,):
        assert df.count() == 10 and df.storageLevel.useMemory
    assert not df.storageLevel.useMemory


def test_unreadable_and_empty_batches_are_answered(spark, tmp_path):
    (tmp_path / "in.json").write_text('{"batch_id": "a", "customers": [{"gender": "Male"}]}\n{"batch_id": "b", "cust\n'
                                      '{"batch_id": "c", "customers": []}\n')
    out = src.explode_batch(src.read_requests(spark, str(tmp_path), corrupt="line")).collect()
    assert sorted((str(r["batch_id"]), r["position"], r["line"] is not None) for r in out) == [
        ("None", None, True), ("a", 0, False), ("c", None, False)]


def test_lines_that_do_not_fit_are_kept(spark, tmp_path):
    (tmp_path / "in.csv").write_text("a,b\n1,x\nabc,y\n3,z,more\n")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    rows = src.read_table(spark, str(tmp_path), schema, corrupt="line").collect()
    assert sorted(str(r["line"]) for r in rows) == ["3,z,more", "None", "abc,y"]


UNEVEN = [31325.35, 84888.92, 269567.47, 110190.86, 3002.4]  # 498975; added as doubles in any order 498974.99999999994


def test_exact_sum(spark):
    from tidemark.functions.columns import exact_sum
    groups = [UNEVEN, UNEVEN[::-1], [float("nan"), 1.0], [float("inf"), 1.0], [1e300, 1.0], [None, 1.5], [None], [9e27] * 3]
    rows = spark.createDataFrame([(k, v) for k, g in enumerate(groups) for v in g], "k int, v double")
    out = {r["k"]: r["s"] for r in rows.groupBy("k").agg(exact_sum("v").alias("s")).collect()}
    assert str(out.pop(2)) == "nan"
    assert out == {0: 498975.0, 1: 498975.0, 3: float("inf"), 4: 1e300, 5: 1.5, 6: None, 7: pytest.approx(2.7e28)}


def test_mean_charge_from_exact_sums(spark, tmp_path):
    """A mean / 3000 of 33.265 exactly, which the sum of doubles made 33.26."""
    from datetime import datetime
    from tidemark.plans.views import raw_customers
    orders = [(k * 10 + i, k, "F", p, datetime(2000, 11, 1), "5-LOW")
              for k, prices in enumerate([UNEVEN, UNEVEN[::-1], [None, 6000.0]]) for i, p in enumerate(prices)]
    (spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                                   "o_orderdate timestamp_ntz, o_orderpriority string")
     .write.parquet(f"{tmp_path}/orders.parquet"))
    (spark.createDataFrame([(k, str(k)) for k in range(4)], "c_custkey long, c_name string")
     .withColumns({"c_nationkey": F.lit(1), "c_acctbal": F.lit(1.0), "c_mktsegment": F.lit("BUILDING")})
     .write.parquet(f"{tmp_path}/customer.parquet"))
    rows = {r["customerID"]: (r["MonthlyCharges"], r["TotalCharges"]) for r in raw_customers(spark, str(tmp_path)).collect()}
    assert rows == {"0": (33.27, "33.27"), "1": (33.27, "33.27"), "2": (2.0, "2.00"), "3": (0.0, " ")}
