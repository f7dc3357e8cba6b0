"""Loading, cleaning, profiling and validating."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators import clean, profile, validate as v
from tidemark.plans.catalog import query
from tidemark.plans.views import (
    CUSTOMER_COLUMNS, CUSTOMERS_SQL, LOG_SQL, RAW_CUSTOMERS_SQL, VALIDATED_SQL, customers,
    field_errors_sql, raw_customers, request_log, table, validated, with_sql,
)
from tidemark.session import work_dir
from tidemark.sources import sinks, tables as src
from tidemark.spec import CUSTOMER, CUSTOMER_FIELDS, categorical_columns, raw_customer_schema

FIELDS = [f.name for f in CUSTOMER_FIELDS]
BATCH_WIDTH = 20
_FIELD_LIST = ", ".join(f'"{f}"' for f in FIELDS)
_TEXT_FIELDS = ", ".join(f'CAST("{f}" AS VARCHAR) AS "{f}"' for f in FIELDS if f != "MonthlyCharges")


# --- sources ------------------------------------------------------------------------------------

@query("read_table_csv", with_sql(RAW_CUSTOMERS_SQL) + "SELECT * FROM raw_customers")
def read_table_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = work_dir(spark, "customers-csv")
    (raw_customers(spark, sf).write.option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
    return src.read_table(spark, path, raw_customer_schema())


@query("read_table_csv_inferred", with_sql(RAW_CUSTOMERS_SQL) + """
SELECT count(*) n, sum(tenure)::BIGINT tenure_sum, sum("SeniorCitizen")::BIGINT seniors,
       count(*) FILTER (WHERE "TotalCharges" = ' ') blank_totals FROM raw_customers""")
def read_table_csv_inferred(spark: SparkSession, sf: str) -> DataFrame:
    path = work_dir(spark, "customers-csv")
    (raw_customers(spark, sf).write.option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
    df = src.read_table(spark, path, infer=True)
    return df.agg(F.count(F.lit(1)).alias("n"), F.sum("tenure").alias("tenure_sum"),
                  F.sum("SeniorCitizen").alias("seniors"),
                  F.count_if(F.col("TotalCharges").cast("string") == " ").alias("blank_totals"))


@query("load_report", with_sql(CUSTOMERS_SQL) + """
SELECT (SELECT count(*) FROM raw_customers) rows_read, (SELECT count(*) FROM customers) rows_kept,
       21 columns_read, (SELECT count(*) FROM raw_customers) - (SELECT count(*) FROM customers) rows_dropped""")
def load_report(spark: SparkSession, sf: str) -> DataFrame:
    return src.load_report(raw_customers(spark, sf), clean.valid_label("Churn", ("Yes", "No")))


@query("schema_report")
def schema_report(spark: SparkSession, sf: str) -> DataFrame:
    return src.schema_report(table(spark, sf, "lineitem"))


def _key() -> "F.Column":
    return F.substring("customerID", 10, 20).cast("bigint")


def _text_requests(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as all-text requests with a batch of at most BATCH_WIDTH consecutive keys."""
    raw = raw_customers(spark, sf)
    return raw.select(
        F.concat(F.lit("batch-"), F.floor(_key() / BATCH_WIDTH).cast("string")).alias("batch_id"),
        _key().alias("custkey"),
        *[F.col(f).cast("string").alias(f) for f in FIELDS if f != "MonthlyCharges"],
        F.col("MonthlyCharges").cast("decimal(18,2)").cast("string").alias("MonthlyCharges"))


def _batches(spark: SparkSession, sf: str) -> DataFrame:
    """One row per batch; a batch spans a fixed width of keys, so its array is small."""
    rows = F.array_sort(F.collect_list(F.struct("custkey", F.struct(*FIELDS).alias("request"))))
    return (_text_requests(spark, sf).groupBy("batch_id").agg(rows.alias("__rows"))
            .select("batch_id", F.col("__rows.request").alias("customers")))


REQUESTS_SQL = RAW_CUSTOMERS_SQL.rstrip() + f""",
requests AS (
  SELECT 'batch-' || CAST(floor(k / {BATCH_WIDTH}.0)::BIGINT AS VARCHAR) batch_id, k custkey, {_TEXT_FIELDS},
         CAST(CAST("MonthlyCharges" AS DECIMAL(18,2)) AS VARCHAR) AS "MonthlyCharges"
  FROM (SELECT *, CAST(substr("customerID", 10) AS BIGINT) k FROM raw_customers))
"""
_EXPLODED = with_sql(REQUESTS_SQL) + f"""
SELECT batch_id, (row_number() OVER (PARTITION BY batch_id ORDER BY custkey) - 1)::INTEGER AS "position", {_FIELD_LIST}
FROM requests"""


@query("read_requests", _EXPLODED)
def read_requests(spark: SparkSession, sf: str) -> DataFrame:
    path = work_dir(spark, "requests-json")
    sinks.write_json(_batches(spark, sf), path)
    return src.explode_batch(src.read_requests(spark, path))


@query("explode_batch", _EXPLODED)
def explode_batch(spark: SparkSession, sf: str) -> DataFrame:
    bodies = _batches(spark, sf).select("batch_id", F.to_json(F.struct("customers")).alias("body"))
    return src.explode_batch(src.parse_requests(bodies, "body"))


# --- cleaning -----------------------------------------------------------------------------------

@query("valid_labels", """
SELECT l_returnflag, l_linestatus, count(*) n FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY ALL""")
def valid_labels(spark: SparkSession, sf: str) -> DataFrame:
    kept = clean.filter_valid_labels(table(spark, sf, "lineitem"), "l_returnflag", ("A", "R"))
    return kept.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))


@query("repair_numeric", with_sql(RAW_CUSTOMERS_SQL) + """
SELECT "customerID", "TotalCharges" total_text,
       CASE WHEN trim("TotalCharges") = '' THEN 0.0::DOUBLE ELSE TRY_CAST("TotalCharges" AS DOUBLE) END total
FROM raw_customers""")
def repair_numeric(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.functions.columns import repair_numeric as repair
    return raw_customers(spark, sf).select(
        "customerID", F.col("TotalCharges").alias("total_text"), repair("TotalCharges").alias("total"))


@query("unparsed_totals", with_sql(RAW_CUSTOMERS_SQL) + """
SELECT "customerID", "TotalCharges", 'TotalCharges: not a number: ' || "TotalCharges" reason FROM raw_customers
WHERE "TotalCharges" IS NOT NULL AND trim("TotalCharges") <> '' AND TRY_CAST("TotalCharges" AS DOUBLE) IS NULL""")
def unparsed_totals(spark: SparkSession, sf: str) -> DataFrame:
    return clean.unparsed(raw_customers(spark, sf), "TotalCharges").select("customerID", "TotalCharges", "reason")


@query("clean_customers", with_sql(CUSTOMERS_SQL) + 'SELECT * EXCLUDE ("customerID") FROM customers')
def clean_customers(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_customers(raw_customers(spark, sf))


@query("drop_columns", "SELECT * EXCLUDE (l_orderkey, l_partkey, l_suppkey) FROM lineitem")
def drop_columns(spark: SparkSession, sf: str) -> DataFrame:
    return clean.drop_columns(table(spark, sf, "lineitem"), ["l_orderkey", "l_partkey", "l_suppkey"])


@query("project", with_sql(CUSTOMERS_SQL) +
       'SELECT "SeniorCitizen", tenure, "MonthlyCharges", "TotalCharges" FROM customers')
def project(spark: SparkSession, sf: str) -> DataFrame:
    return clean.project(customers(spark, sf), CUSTOMER.numeric)


@query("with_defaults", with_sql(CUSTOMERS_SQL) + """
SELECT "customerID", coalesce("TotalCharges", 0.0::DOUBLE) AS "TotalCharges", coalesce("Contract", 'Month-to-month') AS "Contract"
FROM customers""")
def with_defaults(spark: SparkSession, sf: str) -> DataFrame:
    filled = clean.with_defaults(customers(spark, sf), {"TotalCharges": 0.0, "Contract": "Month-to-month"})
    return filled.select("customerID", "TotalCharges", "Contract")


@query("derive_charge", with_sql(CUSTOMERS_SQL) + """
SELECT "customerID", round("MonthlyCharges" * tenure, 2) expected_total FROM customers""")
def derive_charge(spark: SparkSession, sf: str) -> DataFrame:
    return clean.derive_charge(customers(spark, sf), "MonthlyCharges", "tenure", "expected_total").select(
        "customerID", "expected_total")


# --- profiling ----------------------------------------------------------------------------------

@query("row_count", "SELECT count(*) AS \"rows\" FROM lineitem")
def row_count(spark: SparkSession, sf: str) -> DataFrame:
    return src.row_count(table(spark, sf, "lineitem"))


@query("class_distribution", """
SELECT l_returnflag, count(*) AS "count", round(count(*)::DOUBLE / (SELECT count(*) FROM lineitem) * 100, 2) percentage
FROM lineitem GROUP BY l_returnflag""")
def class_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return profile.class_distribution(table(spark, sf, "lineitem"), "l_returnflag")


_LINEITEM_COLUMNS = (
    ("l_orderkey", 0), ("l_partkey", 0), ("l_suppkey", 0), ("l_linenumber", 0), ("l_quantity", 0),
    ("l_extendedprice", 0), ("l_discount", 0), ("l_tax", 0), ("l_returnflag", 1), ("l_linestatus", 1),
    ("l_shipdate", 0))


@query("missing_counts", " UNION ALL ".join(
    f"SELECT '{c}' column_name, count(*) FILTER (WHERE {c} IS NULL{f' OR {c} = ' + chr(39) * 2 if text else ''}) missing FROM lineitem"
    for c, text in _LINEITEM_COLUMNS))
def missing_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profile.missing_counts(table(spark, sf, "lineitem"))


@query("missing_counts_customers", with_sql(CUSTOMERS_SQL) + " UNION ALL ".join(
    f"SELECT '{c}' column_name, count(*) FILTER (WHERE \"{c}\" IS NULL"
    + (f" OR \"{c}\" = ''" if c in CUSTOMER.categorical or c in ("customerID", "Churn") else "")
    + ") missing FROM customers" for c in CUSTOMER_COLUMNS))
def missing_counts_customers(spark: SparkSession, sf: str) -> DataFrame:
    return profile.missing_counts(customers(spark, sf))


_MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("describe_numeric", " UNION ALL ".join(
    f"SELECT '{c}' column_name, count({c}) AS \"count\", round(avg({c}), 4) mean, round(stddev_samp({c}), 4) stddev, "
    f"min({c}) AS \"min\", max({c}) AS \"max\" FROM lineitem" for c in _MEASURES))
def describe_numeric(spark: SparkSession, sf: str) -> DataFrame:
    out = profile.describe_numeric(table(spark, sf, "lineitem"), _MEASURES)
    return out.withColumns({c: F.round(c, 4) for c in ("mean", "stddev")})


@query("sample_rows", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity LIMIT 5""")
def sample_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return profile.sample_rows(rows, ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"])


_SUMMARY_COLUMNS = [c for c in CUSTOMER_COLUMNS if c != "customerID"]
_SUMMARY_SQL = with_sql(CUSTOMERS_SQL) + f"""
SELECT 'total' AS section, 'rows' AS name, CAST(count(*) AS VARCHAR) AS value FROM customers
UNION ALL SELECT 'total', 'columns', '{len(_SUMMARY_COLUMNS)}'
UNION ALL SELECT 'class', "Churn", printf('%d (%.2f%%)', count(*), round(count(*)::DOUBLE / (SELECT count(*) FROM customers) * 100, 2))
  FROM customers GROUP BY "Churn"
UNION ALL SELECT 'columns', 'all', '{", ".join(_SUMMARY_COLUMNS)}'
UNION ALL SELECT 'columns', 'numeric', '{", ".join(CUSTOMER.numeric)}'
UNION ALL SELECT 'columns', 'categorical', '{", ".join(categorical_columns(_SUMMARY_COLUMNS, CUSTOMER))}'
""" + "".join(
    f"UNION ALL SELECT 'missing', '{c}', CAST(count(*) FILTER (WHERE \"{c}\" IS NULL"
    + (f" OR \"{c}\" = ''" if c in CUSTOMER.categorical or c == "Churn" else "")
    + ") AS VARCHAR) FROM customers\n" for c in _SUMMARY_COLUMNS)


@query("exploration_summary", _SUMMARY_SQL)
def exploration_summary(spark: SparkSession, sf: str) -> DataFrame:
    return profile.exploration_summary(customers(spark, sf).drop("customerID"), CUSTOMER)


@query("exploration_file", _SUMMARY_SQL.replace(
    with_sql(CUSTOMERS_SQL), with_sql(CUSTOMERS_SQL.rstrip() + ", summary AS (") .rstrip()) +
    ") SELECT section || chr(9) || name || chr(9) || value AS value FROM summary")
def exploration_file(spark: SparkSession, sf: str) -> DataFrame:
    path = work_dir(spark, "exploration")
    sinks.write_exploration(exploration_summary(spark, sf), path)
    return spark.read.text(path)


# --- validation ---------------------------------------------------------------------------------

@query("validate_rows", with_sql(VALIDATED_SQL) + 'SELECT "customerID", status, detail FROM validated')
def validate_rows(spark: SparkSession, sf: str) -> DataFrame:
    return validated(spark, sf).select("customerID", "status", "detail")


@query("validate_requests", with_sql(REQUESTS_SQL.rstrip() + f""",
checked AS (SELECT batch_id, custkey, list_filter({field_errors_sql(True)}, lambda x: x IS NOT NULL) errors FROM requests)""") + """
SELECT batch_id, custkey, coalesce(array_to_string(errors, '; '), '') detail, len(errors)::INTEGER n_errors FROM checked""")
def validate_requests(spark: SparkSession, sf: str) -> DataFrame:
    return v.validate(_text_requests(spark, sf)).select(
        "batch_id", "custkey", "detail", F.size("errors").alias("n_errors"))


@query("quarantine_split", with_sql(VALIDATED_SQL) + """
SELECT CASE status WHEN 'valid' THEN 'accepted' ELSE 'quarantine' END side, "customerID",
       CASE status WHEN 'invalid' THEN detail END detail FROM validated""")
def quarantine_split(spark: SparkSession, sf: str) -> DataFrame:
    ok, bad = v.split_valid(validated(spark, sf))
    return (ok.select(F.lit("accepted").alias("side"), "customerID", F.lit(None).cast("string").alias("detail"))
            .unionByName(bad.select(F.lit("quarantine").alias("side"), "customerID", "detail")))


@query("batch_sizes", with_sql(LOG_SQL) + """
SELECT batch_id, count(*) batch_size, count(*) BETWEEN 1 AND 5 accepted FROM log GROUP BY batch_id""")
def batch_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return v.check_batch_sizes(request_log(spark, sf), "batch_id", 1, 5)


@query("batch_list_sizes", with_sql(REQUESTS_SQL) + """
SELECT batch_id, count(*)::INTEGER batch_size, count(*) BETWEEN 1 AND 1000 accepted FROM requests GROUP BY batch_id""")
def batch_list_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return v.check_list_sizes(_batches(spark, sf), "customers").drop("customers")
