"""Splits, folds, samples and feature engineering."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators import features as fe, importance, split as sp
from tidemark.plans.catalog import query
from tidemark.plans.views import CUSTOMERS_SQL, customers, table, with_sql
from tidemark.spec import CUSTOMER, CUSTOMER_FIELDS


def _hash(key: str, seed: int) -> str:
    return f"('0x' || substr(md5(CAST({key} AS VARCHAR) || '{seed}'), 1, 8))::BIGINT"


def _slot(key: str, seed: int, slots: int) -> str:
    return f"({_hash(key, seed)} % {slots})"


_SIDE = f"CASE WHEN {_hash('l_orderkey', 42)} < 0.8 * 4294967296 THEN 'train' ELSE 'test' END"


@query("split_counts", f"""
SELECT {_SIDE} side, count(*) n, sum(l_linenumber)::BIGINT line_sum FROM lineitem GROUP BY 1""")
def split_counts(spark: SparkSession, sf: str) -> DataFrame:
    train, test = sp.split(table(spark, sf, "lineitem"), 0.8, 42, "l_orderkey")
    both = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    return both.groupBy("side").agg(F.count(F.lit(1)).alias("n"), F.sum("l_linenumber").alias("line_sum"))


@query("random_split", "SELECT count(*) n FROM lineitem")
def random_split(spark: SparkSession, sf: str) -> DataFrame:
    """Without a key the sides depend on partitioning, but together they are the whole table."""
    train, test = sp.split(table(spark, sf, "lineitem"))
    return train.unionByName(test).agg(F.count(F.lit(1)).alias("n"))


@query("fold_counts", f"""
SELECT {_slot('l_orderkey', 43, 3)}::INTEGER fold, count(*) n FROM lineitem GROUP BY 1""")
def fold_counts(spark: SparkSession, sf: str) -> DataFrame:
    return sp.with_folds(table(spark, sf, "lineitem"), "l_orderkey", 3).groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"))


@query("sample_n", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '42'), o_orderkey LIMIT 500""")
def sample_n(spark: SparkSession, sf: str) -> DataFrame:
    return sp.sample_n(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), 500, "o_orderkey")


@query("label_index", """
SELECT o_orderkey, o_orderstatus, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 END label_index FROM orders""")
def label_index(spark: SparkSession, sf: str) -> DataFrame:
    return fe.label_index(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus")


_CATEGORY_SQL = CUSTOMERS_SQL.rstrip() + """,
pairs AS (""" + " UNION ALL ".join(
    f"SELECT '{c}' column_name, {i} place, \"{c}\" AS value FROM customers" for i, c in enumerate(CUSTOMER.categorical)) + """),
categories AS (
  SELECT column_name, place, value, count(*) AS "count",
         (row_number() OVER (PARTITION BY column_name ORDER BY count(*) DESC, value) - 1)::INTEGER AS "index"
  FROM pairs WHERE value IS NOT NULL GROUP BY column_name, place, value)"""


@query("category_index", with_sql(_CATEGORY_SQL) + 'SELECT column_name, value, "count", "index" FROM categories')
def category_index(spark: SparkSession, sf: str) -> DataFrame:
    return fe.category_index(customers(spark, sf), CUSTOMER.categorical)


@query("category_index_ml", with_sql(_CATEGORY_SQL) + 'SELECT column_name, value, "index" FROM categories')
def category_index_ml(spark: SparkSession, sf: str) -> DataFrame:
    """The fitted indexer's labels; one row per category."""
    model = fe.category_indexers(CUSTOMER).fit(customers(spark, sf))
    rows = [(c, v, i) for c, values in zip(CUSTOMER.categorical, model.labelsArray) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "column_name string, value string, index int")


_MOST = 50


@query("kept_categories", """WITH pairs AS (
  SELECT 'o_custkey' column_name, o_custkey::VARCHAR AS value FROM orders
  UNION ALL SELECT 'o_orderdate', CAST(o_orderdate AS DATE)::VARCHAR FROM orders
  UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM orders
  UNION ALL SELECT 'spender', CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority ELSE o_orderkey::VARCHAR END FROM orders),
counts AS (SELECT column_name, value, count(*) AS "count" FROM pairs WHERE value IS NOT NULL GROUP BY column_name, value),
sums AS (SELECT column_name, sum("count") total, count(*) different FROM counts GROUP BY column_name)
SELECT column_name, value, "count" FROM counts JOIN sums USING (column_name)
WHERE different <= """ + str(_MOST) + ' OR "count" * ' + str(_MOST) + ' > total')
def kept_categories(spark: SparkSession, sf: str) -> DataFrame:
    """Columns of few, of many equally rare, and of some frequent and many rare values."""
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    wide = orders.select("o_custkey", F.to_date("o_orderdate").alias("o_orderdate"), "o_orderpriority", F.when(
        F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")).otherwise(F.col("o_orderkey").cast("string")).alias("spender"))
    return fe.kept_categories(wide, wide.columns, _MOST)


_CATEGORIES = {f.name: f.allowed for f in CUSTOMER_FIELDS if f.name in CUSTOMER.categorical}


@query("one_hot", with_sql(CUSTOMERS_SQL) + 'SELECT "customerID", ' + ", ".join(
    f"CASE WHEN \"{c}\" = '{v}' THEN 1 ELSE 0 END AS \"{c}_{v}\"" for c, vs in _CATEGORIES.items() for v in vs)
    + " FROM customers")
def one_hot(spark: SparkSession, sf: str) -> DataFrame:
    return fe.one_hot_columns(customers(spark, sf).select("customerID", *_CATEGORIES), _CATEGORIES).drop(*_CATEGORIES)


_SCALED = ("l_quantity", "l_extendedprice", "l_discount")


@query("standardize", "SELECT l_orderkey, l_linenumber, l_partkey, " + ", ".join(
    f"round(({c} - (SELECT avg({c}) FROM lineitem)) / (SELECT stddev_samp({c}) FROM lineitem), 4) AS {c}_std"
    for c in _SCALED) + " FROM lineitem")
def standardize(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", *_SCALED)
    return fe.standardize(rows, _SCALED).select(
        "l_orderkey", "l_linenumber", "l_partkey", *[F.round(f"{c}_std", 4).alias(f"{c}_std") for c in _SCALED])


_SLOTS_SQL = _CATEGORY_SQL + """,
slots AS (
  SELECT place, "index" AS inner_place, column_name AS feature, column_name || '=' || value AS slot FROM categories
  UNION ALL SELECT * FROM (VALUES """ + ", ".join(
    f"({len(CUSTOMER.categorical) + i}, 0, '{c}', '{c}')" for i, c in enumerate(CUSTOMER.numeric)) + """))"""


@query("feature_slots", with_sql(_SLOTS_SQL) + """
SELECT (row_number() OVER (ORDER BY place, inner_place) - 1)::INTEGER idx, feature, slot FROM slots""")
def feature_slots(spark: SparkSession, sf: str) -> DataFrame:
    """Which column and category every slot of the feature vector stands for."""
    model = Pipeline(stages=fe.feature_stages(CUSTOMER)).fit(customers(spark, sf))
    rows = [(i, f, s) for i, (f, s) in enumerate(importance.slot_names(model))]
    return spark.createDataFrame(rows, "idx int, feature string, slot string")


@query("feature_vectors", with_sql(_SLOTS_SQL + """,
usable AS (SELECT * FROM customers WHERE "TotalCharges" IS NOT NULL),
raw_slots AS (
  SELECT "customerID", s.idx, CASE s.feature """ + " ".join(
    f"WHEN '{c}' THEN CASE WHEN s.slot = '{c}=' || \"{c}\" THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END" for c in CUSTOMER.categorical)
    + " " + " ".join(f"WHEN '{c}' THEN \"{c}\"::DOUBLE" for c in CUSTOMER.numeric) + """ END AS value
  FROM usable CROSS JOIN (SELECT (row_number() OVER (ORDER BY place, inner_place) - 1)::INTEGER idx, feature, slot FROM slots) s),
moments AS (SELECT idx, avg(value) mean, stddev_samp(value) std FROM raw_slots GROUP BY idx)""") + """
SELECT "customerID", idx, round(CASE WHEN std > 0 THEN (value - mean) / std ELSE 0 END, 4) AS value FROM raw_slots JOIN moments USING (idx)""")
def feature_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Scaled feature vectors in long form: one row per customer and slot."""
    rows = customers(spark, sf)
    vectors = Pipeline(stages=fe.feature_stages(CUSTOMER)).fit(rows).transform(rows)
    return vectors.select("customerID", F.posexplode(vector_to_array("features")).alias("idx", "value")).withColumn(
        "value", F.round("value", 4))
