"""The tables the queries work on, derived from the provided star schema.

* customers: orders and customers shaped like the 21-column customer file
* request log: events shaped like the scoring service's log
* supplier runs: three simple rules per supplier, evaluated like training runs
* documents: numeric features of whole texts with their quality label

Each view has a Spark function and the same definition as a SQL fragment (``*_SQL``,
the inside of a WITH clause).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.columns import confidence_level, exact_sum
from tidemark.operators import registry, runs
from tidemark.operators.clean import clean_customers
from tidemark.operators.metrics import evaluate_groups
from tidemark.operators.scoring import score_batch
from tidemark.operators.validate import validate
from tidemark.sources.sinks import materialize
from tidemark.spec import CUSTOMER_FIELDS, FeatureSpec

CUTOFF = "2000-12-01 00:00:00"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def with_sql(*fragments: str) -> str:
    return "WITH " + ",\n".join(f.strip() for f in fragments) + "\n"


# --- customers ----------------------------------------------------------------------------------

def raw_customers(spark: SparkSession, sf: str) -> DataFrame:
    """One pass over orders (before and after the cut-off together), one join by customer key."""
    orders = table(spark, sf, "orders")
    pre = F.col("o_orderdate") < ntz(CUTOFF)
    price = F.when(pre, F.col("o_totalprice"))
    paid = F.when(pre & (F.col("o_orderstatus") != "P"), F.col("o_totalprice"))
    place = F.when(pre, F.struct("o_orderdate", "o_orderkey"))

    def status(s: str) -> Column:
        return F.count_if(pre & (F.col("o_orderstatus") == s))

    history = orders.groupBy("o_custkey").agg(
        F.count_if(pre).alias("n_pre"), F.count_if(~pre).alias("n_post"),
        status("P").alias("n_p"), status("F").alias("n_f"), status("O").alias("n_o"),
        F.count_if(pre & (F.col("o_orderpriority") == "1-URGENT")).alias("n_urgent"),
        F.count_if(pre & (F.col("o_orderpriority") == "5-LOW")).alias("n_low"),
        F.min(F.when(pre, F.col("o_orderdate"))).alias("first_order"),
        F.max(price).alias("top"), F.min(price).alias("bottom"),
        exact_sum(paid).alias("paid"), F.count(paid).alias("n_paid"),
        F.max_by("o_orderpriority", place).alias("last_priority"),
        F.max_by("o_orderstatus", place).alias("last_status"))
    base = table(spark, sf, "customer").join(history, F.col("c_custkey") == F.col("o_custkey"), "left")

    days = F.datediff(F.lit(CUTOFF).cast("date"), F.col("first_order").cast("date"))
    base = base.withColumns({
        "tenure": F.coalesce(F.floor(days / 30), F.lit(0)).cast("int"),
        "MonthlyCharges": F.coalesce(F.round(F.col("paid") / F.col("n_paid") / F.lit(3000.0), 2), F.lit(0.0)),
        "InternetService": F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "Fiber optic")
        .when(F.col("c_mktsegment").isin("AUTOMOBILE", "FURNITURE"), "DSL").otherwise("No"),
        "PhoneService": yes_no(F.col("n_p") > 0)})

    def add_on(condition: Column) -> Column:
        return F.when(F.col("InternetService") == "No", "No internet service").otherwise(yes_no(condition))

    total = F.round(F.col("MonthlyCharges") * F.col("tenure"), 2).cast("decimal(18,2)").cast("string")
    return base.select(
        F.col("c_name").alias("customerID"),
        F.when(F.col("c_nationkey") < 12, "Female").otherwise("Male").alias("gender"),
        F.when(F.col("c_acctbal") >= 8000, 1).otherwise(0).alias("SeniorCitizen"),
        yes_no(F.col("n_urgent") >= 2).alias("Partner"), yes_no(F.col("n_low") >= 2).alias("Dependents"),
        "tenure", "PhoneService",
        F.when(F.col("PhoneService") == "No", "No phone service").otherwise(yes_no(F.col("n_p") >= 3)).alias("MultipleLines"),
        "InternetService",
        add_on(F.col("n_f") >= 4).alias("OnlineSecurity"), add_on(F.col("n_o") >= 4).alias("OnlineBackup"),
        add_on(F.col("top") > 450000).alias("DeviceProtection"), add_on(F.col("bottom") < 30000).alias("TechSupport"),
        add_on(F.col("n_pre") >= 10).alias("StreamingTV"), add_on(F.col("n_pre") >= 13).alias("StreamingMovies"),
        F.when(F.col("last_status") == "P", "Month-to-month").when(F.col("last_status") == "O", "One year")
        .otherwise("Two year").alias("Contract"),
        yes_no(F.col("c_acctbal") > 4500).alias("PaperlessBilling"),
        F.when(F.col("last_priority") == "1-URGENT", "Electronic check")
        .when(F.col("last_priority") == "2-HIGH", "Mailed check")
        .when(F.col("last_priority") == "3-MEDIUM", "Bank transfer (automatic)")
        .when(F.col("last_priority") == "5-LOW", "Credit card (automatic)")
        .otherwise("Not specified").alias("PaymentMethod"),
        "MonthlyCharges",
        F.when(F.col("tenure") == 0, " ").when(F.col("MonthlyCharges") == 0, "n/a").otherwise(total).alias("TotalCharges"),
        F.when(F.coalesce("n_pre", F.lit(0)) == 0, "Unknown").when(F.col("n_post") > 0, "No").otherwise("Yes").alias("Churn"))


def yes_no(condition: Column) -> Column:
    return F.when(condition, "Yes").otherwise("No")


RAW_CUSTOMERS_SQL = """
history AS (
  SELECT o_custkey, count(*) FILTER (WHERE pre) n_pre, count(*) FILTER (WHERE NOT pre) n_post,
         count(*) FILTER (WHERE pre AND o_orderstatus = 'P') n_p,
         count(*) FILTER (WHERE pre AND o_orderstatus = 'F') n_f,
         count(*) FILTER (WHERE pre AND o_orderstatus = 'O') n_o,
         count(*) FILTER (WHERE pre AND o_orderpriority = '1-URGENT') n_urgent,
         count(*) FILTER (WHERE pre AND o_orderpriority = '5-LOW') n_low,
         min(o_orderdate) FILTER (WHERE pre) first_order,
         max(o_totalprice) FILTER (WHERE pre) top, min(o_totalprice) FILTER (WHERE pre) bottom,
         sum(o_totalprice) FILTER (WHERE pre AND o_orderstatus <> 'P') paid,
         count(*) FILTER (WHERE pre AND o_orderstatus <> 'P') n_paid,
         max_by(o_orderpriority, row(o_orderdate, o_orderkey)) FILTER (WHERE pre) last_priority,
         max_by(o_orderstatus, row(o_orderdate, o_orderkey)) FILTER (WHERE pre) last_status
  FROM (SELECT *, o_orderdate < TIMESTAMP '2000-12-01 00:00:00' pre FROM orders) GROUP BY o_custkey),
shaped AS (
  SELECT *, coalesce(floor(date_diff('day', CAST(first_order AS DATE), DATE '2000-12-01') / 30.0), 0)::INTEGER tenure,
         CASE WHEN n_paid > 0 THEN round(paid / n_paid / 3000.0::DOUBLE, 2) ELSE 0.0::DOUBLE END monthly,
         CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'Fiber optic'
              WHEN c_mktsegment IN ('AUTOMOBILE', 'FURNITURE') THEN 'DSL' ELSE 'No' END internet,
         CASE WHEN n_p > 0 THEN 'Yes' ELSE 'No' END phone
  FROM customer LEFT JOIN history ON c_custkey = o_custkey),
raw_customers AS (
  SELECT c_name AS "customerID", CASE WHEN c_nationkey < 12 THEN 'Female' ELSE 'Male' END AS gender,
         CASE WHEN c_acctbal >= 8000 THEN 1 ELSE 0 END AS "SeniorCitizen",
         CASE WHEN n_urgent >= 2 THEN 'Yes' ELSE 'No' END AS "Partner",
         CASE WHEN n_low >= 2 THEN 'Yes' ELSE 'No' END AS "Dependents",
         tenure, phone AS "PhoneService",
         CASE WHEN phone = 'No' THEN 'No phone service' WHEN n_p >= 3 THEN 'Yes' ELSE 'No' END AS "MultipleLines",
         internet AS "InternetService",
         CASE WHEN internet = 'No' THEN 'No internet service' WHEN n_f >= 4 THEN 'Yes' ELSE 'No' END AS "OnlineSecurity",
         CASE WHEN internet = 'No' THEN 'No internet service' WHEN n_o >= 4 THEN 'Yes' ELSE 'No' END AS "OnlineBackup",
         CASE WHEN internet = 'No' THEN 'No internet service' WHEN top > 450000 THEN 'Yes' ELSE 'No' END AS "DeviceProtection",
         CASE WHEN internet = 'No' THEN 'No internet service' WHEN bottom < 30000 THEN 'Yes' ELSE 'No' END AS "TechSupport",
         CASE WHEN internet = 'No' THEN 'No internet service' WHEN n_pre >= 10 THEN 'Yes' ELSE 'No' END AS "StreamingTV",
         CASE WHEN internet = 'No' THEN 'No internet service' WHEN n_pre >= 13 THEN 'Yes' ELSE 'No' END AS "StreamingMovies",
         CASE WHEN last_status = 'P' THEN 'Month-to-month' WHEN last_status = 'O' THEN 'One year' ELSE 'Two year' END AS "Contract",
         CASE WHEN c_acctbal > 4500 THEN 'Yes' ELSE 'No' END AS "PaperlessBilling",
         CASE WHEN last_priority = '1-URGENT' THEN 'Electronic check' WHEN last_priority = '2-HIGH' THEN 'Mailed check'
              WHEN last_priority = '3-MEDIUM' THEN 'Bank transfer (automatic)'
              WHEN last_priority = '5-LOW' THEN 'Credit card (automatic)' ELSE 'Not specified' END AS "PaymentMethod",
         monthly AS "MonthlyCharges",
         CASE WHEN tenure = 0 THEN ' ' WHEN monthly = 0 THEN 'n/a'
              ELSE CAST(CAST(round(monthly * tenure, 2) AS DECIMAL(18,2)) AS VARCHAR) END AS "TotalCharges",
         CASE WHEN coalesce(n_pre, 0) = 0 THEN 'Unknown' WHEN n_post > 0 THEN 'No' ELSE 'Yes' END AS "Churn"
  FROM shaped)
"""

CUSTOMER_COLUMNS = ["customerID", *[f.name for f in CUSTOMER_FIELDS], "Churn"]


def customers(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned customers with their id."""
    return clean_customers(raw_customers(spark, sf), drop=())


CUSTOMERS_SQL = RAW_CUSTOMERS_SQL.rstrip() + """,
customers AS (
  SELECT * REPLACE (CASE WHEN trim("TotalCharges") = '' THEN 0.0::DOUBLE
                         ELSE TRY_CAST("TotalCharges" AS DOUBLE) END AS "TotalCharges")
  FROM raw_customers WHERE "Churn" IN ('Yes', 'No'))
"""


def _quoted(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _expected(values) -> str:
    shown = [f"'{v}'" if isinstance(v, str) else str(v) for v in values]
    return " or ".join([", ".join(shown[:-1]), shown[-1]])


def field_errors_sql(text_rows: bool) -> str:
    """SQL list of the message of each field; ``text_rows`` adds the type checks."""
    items = []
    for f in CUSTOMER_FIELDS:
        c = f'"{f.name}"'
        cases = [(f"{c} IS NULL", "Field required")]
        if text_rows and f.type != "string":
            kind, word = ("INTEGER", "integer") if f.type == "int" else ("DOUBLE", "number")
            cases.append((f"TRY_CAST({c} AS {kind}) IS NULL", f"Input should be a valid {word}"))
            c = f"TRY_CAST({c} AS {kind})"
        if f.allowed:
            cases.append((f"{c} NOT IN ({_quoted(f.allowed)})", f"Input should be {_expected(f.allowed)}"))
        if f.ge is not None:
            cases.append((f"{c} < {f.ge}", f"Input should be greater than or equal to {f.ge}"))
        if f.gt is not None:
            cases.append((f"{c} <= {f.gt}", f"Input should be greater than {f.gt}"))
        if f.le is not None:
            cases.append((f"{c} > {f.le}", f"Input should be less than or equal to {f.le}"))
        when = " ".join(f"WHEN {test} THEN {_sql_text(f.name + ': ' + message)}" for test, message in cases)
        items.append(f"CASE {when} END")
    return "[" + ",\n".join(items) + "]"


VALIDATED_SQL = CUSTOMERS_SQL.rstrip() + f""",
messages AS (SELECT *, list_filter({field_errors_sql(False)}, lambda x: x IS NOT NULL) errors FROM customers),
validated AS (
  SELECT *, coalesce(array_to_string(errors, '; '), '') detail,
         CASE WHEN len(errors) = 0 THEN 'valid' ELSE 'invalid' END status FROM messages)
"""


def validated(spark: SparkSession, sf: str) -> DataFrame:
    return validate(customers(spark, sf))


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Every cleaned customer with the response columns; invalid rows have no score."""
    return score_batch(validated(spark, sf), version="1", key="customerID")


# Weights as plain CASE expressions, added in the same order.
RULE_SCORE_SQL = """
greatest(0.01::DOUBLE, least(0.99::DOUBLE, 0.0::DOUBLE
 + (CASE "Contract" WHEN 'Month-to-month' THEN 0.30::DOUBLE WHEN 'One year' THEN 0.10::DOUBLE ELSE 0.02::DOUBLE END)
 + (CASE WHEN tenure <= 6 THEN 0.20::DOUBLE WHEN tenure <= 12 THEN 0.12::DOUBLE WHEN tenure <= 24 THEN 0.06::DOUBLE ELSE 0.01::DOUBLE END)
 + (CASE WHEN "MonthlyCharges" > 90 THEN 0.12::DOUBLE WHEN "MonthlyCharges" > 70 THEN 0.08::DOUBLE
         WHEN "MonthlyCharges" > 50 THEN 0.04::DOUBLE ELSE 0.01::DOUBLE END)
 + (CASE "InternetService" WHEN 'Fiber optic' THEN 0.10::DOUBLE WHEN 'DSL' THEN 0.03::DOUBLE ELSE 0.0::DOUBLE END)
 + (CASE "PaymentMethod" WHEN 'Electronic check' THEN 0.08::DOUBLE ELSE 0.02::DOUBLE END)
 + (CASE "OnlineSecurity" WHEN 'Yes' THEN -0.05::DOUBLE ELSE 0.0::DOUBLE END)
 + (CASE "TechSupport" WHEN 'Yes' THEN -0.05::DOUBLE ELSE 0.0::DOUBLE END)
 + (CASE "PaperlessBilling" WHEN 'Yes' THEN 0.03::DOUBLE ELSE 0.0::DOUBLE END)
 + (CASE "SeniorCitizen" WHEN 1 THEN 0.04::DOUBLE ELSE 0.0::DOUBLE END)))
"""


def level_sql(score: str) -> str:
    return (f"CASE WHEN abs({score} - 0.5::DOUBLE) >= 0.3::DOUBLE THEN 'high' "
            f"WHEN abs({score} - 0.5::DOUBLE) >= 0.15::DOUBLE THEN 'medium' "
            f"WHEN {score} IS NOT NULL THEN 'low' END")


def scored_sql(source: str, out: str, key: str = '"customerID"') -> str:
    """Fragment ``out`` scoring the rows of ``source`` (which has ``status``)."""
    return f"""
{out}_raw AS (SELECT *, CASE WHEN status = 'valid' THEN {RULE_SCORE_SQL} END raw_score FROM {source}),
{out} AS (
  SELECT * EXCLUDE (raw_score), raw_score >= 0.5::DOUBLE churn_prediction, round(raw_score, 4) churn_probability,
         {level_sql('round(raw_score, 4)')} confidence, '1' model_version, md5({key}) prediction_id
  FROM {out}_raw)"""


SCORED_SQL = VALIDATED_SQL.rstrip() + "," + scored_sql("validated", "scored")


# --- request log ----------------------------------------------------------------------------------

def shape_log(events: DataFrame) -> DataFrame:
    """Events as the request log; works on a stream as well."""
    score = F.get_json_object("props", "$.k").try_cast("int") / F.lit(100.0)
    return events.select(
        "event_id", "ts", F.lit("POST").alias("method"), F.col("event_type").alias("handler"),
        F.when(F.col("event_type") == "error", 500).when(score < 0.02, 422).otherwise(200).alias("status"),
        F.when(F.col("event_type") == "signup", "batch").otherwise("fastapi").alias("job"),
        (F.col("value") / F.lit(100.0)).alias("latency_s"), score.alias("score"),
        F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd")).alias("batch_id"),
    ).withColumns({"churn_prediction": F.col("score") >= 0.5, "confidence": confidence_level("score")})


def request_log(spark: SparkSession, sf: str) -> DataFrame:
    return shape_log(table(spark, sf, "events"))


LOG_SQL = f"""
log_base AS (
  SELECT *, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) / 100.0::DOUBLE score FROM events),
log AS (
  SELECT event_id, ts, 'POST' AS method, event_type AS handler,
         CASE WHEN event_type = 'error' THEN 500 WHEN score < 0.02::DOUBLE THEN 422 ELSE 200 END status,
         CASE WHEN event_type = 'signup' THEN 'batch' ELSE 'fastapi' END job,
         value / 100.0::DOUBLE latency_s, score,
         CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') batch_id,
         score >= 0.5::DOUBLE churn_prediction, {level_sql('score')} confidence
  FROM log_base)
"""


def covered_sql(range_s: int, step_s: int) -> str:
    """Starts of the trailing ranges that cover ``ts``."""
    step, back = step_s * 1_000_000, range_s - step_s
    slot = f"make_timestamp((epoch_us(ts) // {step}) * {step})"
    return (f"unnest(generate_series({slot} - INTERVAL {back} SECOND, {slot}, "
            f"INTERVAL {step_s} SECOND)) AS window_start")


# --- supplier runs --------------------------------------------------------------------------------

# Three rules per supplier: (algorithm, run suffix, order, score column expression)
RULES = (("Quantity Rule", "q", 1), ("Discount Rule", "d", 2), ("Tax Rule", "t", 3))


def rule_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Returned or accepted line items scored by each rule: one pass, three rows per line.
    The keys stay numbers here; names are made from the few result rows."""
    lines = table(spark, sf, "lineitem").where(F.col("l_returnflag").isin("A", "R"))
    score = {"q": F.col("l_quantity") / F.lit(50.0), "d": F.col("l_discount") * F.lit(10.0),
             "t": F.col("l_tax") * F.lit(12.5)}
    rows = F.array(*[F.struct(F.lit(order).alias("logged_order"), score[suffix].alias("score"))
                     for _, suffix, order in RULES])
    label = F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label")
    return lines.select("l_suppkey", label, F.inline(rows)).withColumn(
        "prediction", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def rule_name(part: int) -> Column:
    """Algorithm (0) or run suffix (1) of a rule, from its order."""
    return F.element_at(F.array(*[F.lit(rule[part]) for rule in RULES]), F.col("logged_order"))


RULE_SCORES_SQL = """
lines AS (SELECT *, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END label,
                 CAST(l_suppkey AS VARCHAR) s FROM lineitem WHERE l_returnflag IN ('A', 'R')),
rule_scores AS (
  SELECT *, CASE WHEN score >= 0.5::DOUBLE THEN 1 ELSE 0 END prediction FROM (
    SELECT label, 'supplier-' || s AS name, 'run-' || s || '-q' run_id, 'Quantity Rule' algorithm, 1 logged_order,
           l_quantity / 50.0::DOUBLE score FROM lines
    UNION ALL SELECT label, 'supplier-' || s, 'run-' || s || '-d', 'Discount Rule', 2, l_discount * 10.0::DOUBLE FROM lines
    UNION ALL SELECT label, 'supplier-' || s, 'run-' || s || '-t', 'Tax Rule', 3, l_tax * 12.5::DOUBLE FROM lines))
"""

def supplier_runs(spark: SparkSession, sf: str) -> DataFrame:
    """One row per run with the six recorded metrics."""
    out = evaluate_groups(rule_scores(spark, sf), "score", "label", ["l_suppkey", "logged_order"])
    rows = F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")
    supplier = F.col("l_suppkey").cast("string")
    return out.select(
        F.concat(F.lit("supplier-"), supplier).alias("name"),
        F.concat(F.lit("run-"), supplier, F.lit("-"), rule_name(1)).alias("run_id"),
        rule_name(0).alias("algorithm"), "logged_order",
        (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(days="logged_order")).alias("created_at"),
        F.round("auc_roc", 9).alias("auc_roc"), F.round("accuracy", 9).alias("accuracy"),
        F.round("weighted_precision", 9).alias("precision"), F.round("weighted_recall", 9).alias("recall"),
        F.round("weighted_f1", 9).alias("f1_score"), (rows / F.lit(1000.0)).alias("training_duration_seconds"))


SUPPLIER_RUNS_SQL = RULE_SCORES_SQL.rstrip() + """,
run_counts AS (
  SELECT name, run_id, algorithm, logged_order, score,
         count(*) FILTER (WHERE label = 1)::DOUBLE pos, count(*) FILTER (WHERE label = 0)::DOUBLE neg
  FROM rule_scores GROUP BY ALL),
run_running AS (
  SELECT *, sum(pos) OVER (PARTITION BY run_id ORDER BY score DESC ROWS UNBOUNDED PRECEDING) pos_run FROM run_counts),
run_cells AS (
  SELECT name, run_id, algorithm, logged_order, sum(neg * (pos_run - pos / 2.0::DOUBLE)) area,
         sum(pos) p, sum(neg) n, sum(CASE WHEN score >= 0.5::DOUBLE THEN pos ELSE 0 END) tp,
         sum(CASE WHEN score >= 0.5::DOUBLE THEN neg ELSE 0 END) fp FROM run_running GROUP BY ALL),
run_ratios AS (
  SELECT *, CASE WHEN p * n > 0 THEN area / (p * n) ELSE 0.0 END auc, (tp + n - fp) / (p + n) acc,
         CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END p1, CASE WHEN p > 0 THEN tp / p ELSE 0.0 END r1,
         CASE WHEN n - fp + p - tp > 0 THEN (n - fp) / (n - fp + p - tp) ELSE 0.0 END p0,
         CASE WHEN n > 0 THEN (n - fp) / n ELSE 0.0 END r0 FROM run_cells),
supplier_runs AS (
  SELECT name, run_id, algorithm, logged_order,
         TIMESTAMP '2024-01-01 00:00:00' + to_days(logged_order) created_at,
         round(auc, 9) auc_roc, round(acc, 9) accuracy, round((p0 * n + p1 * p) / (p + n), 9) "precision",
         round((r0 * n + r1 * p) / (p + n), 9) recall,
         round(((CASE WHEN p0 + r0 > 0 THEN 2 * p0 * r0 / (p0 + r0) ELSE 0.0 END) * n
              + (CASE WHEN p1 + r1 > 0 THEN 2 * p1 * r1 / (p1 + r1) ELSE 0.0 END) * p) / (p + n), 9) f1_score,
         (p + n) / 1000.0::DOUBLE training_duration_seconds
  FROM run_ratios)
"""


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def runs_table(spark: SparkSession, sf: str) -> DataFrame:
    """The evaluated runs logged to a table: the large scan happens once, when it is written."""
    return materialize(supplier_runs(spark, sf), "runs")


def versions(spark: SparkSession, all_runs: DataFrame) -> DataFrame:
    """The runs of every supplier registered in the order they were logged, as a table."""
    text = runs.describe_run(*[F.col(c) for c in (
        "algorithm", "auc_roc", "accuracy", "f1_score", "training_duration_seconds")])
    candidates = all_runs.select("name", "run_id", F.concat(F.lit("runs:/"), "run_id", F.lit("/model")).alias("source"),
                                 text.alias("description"), "created_at")
    return materialize(registry.register_versions(candidates, empty(spark, registry.VERSIONS)), "versions")


VERSIONS_SQL = SUPPLIER_RUNS_SQL.rstrip() + """,
versions AS (
  SELECT name, run_id, 'runs:/' || run_id || '/model' AS source,
         'best run by AUC, ' || algorithm || '; auc ' || printf('%.4f', round(auc_roc, 4)) || '; accuracy ' || printf('%.4f', round(accuracy, 4))
         || '; f1 ' || printf('%.4f', round(f1_score, 4)) || '; fitted in ' || printf('%.1f', round(training_duration_seconds, 1)) || ' seconds' description,
         created_at, row_number() OVER (PARTITION BY name ORDER BY created_at)::INTEGER AS version
  FROM supplier_runs)
"""

FIRST_LIVE = "2024-02-01 00:00:00"
PROMOTED = "2024-03-01 00:00:00"
ROLLED_BACK = "2024-04-01 00:00:00"
SUPPLIER_GATE = 0.5


def base_events(all_versions: DataFrame) -> DataFrame:
    """Every version registered, version 1 of every model in Production."""
    first = all_versions.where(F.col("version") == 1)
    return registry.registration_events(all_versions).unionByName(
        registry.stage_events(first, "Production", F.lit(FIRST_LIVE), 0))


EVENTS_SQL = VERSIONS_SQL.rstrip() + f""",
base_events AS (
  SELECT name, version, 'None' stage, created_at AS "at", 0 step FROM versions
  UNION ALL SELECT name, version, 'Staging', created_at, 1 FROM versions
  UNION ALL SELECT name, version, 'Production', TIMESTAMP '{FIRST_LIVE}', 0 FROM versions WHERE version = 1)
"""


def states_sql(events: str, out: str) -> str:
    return f"""
{out} AS (SELECT name, version, max_by(stage, row("at", step)) stage, max("at") AS since FROM {events} GROUP BY name, version)"""


DECISIONS_SQL = EVENTS_SQL.rstrip() + "," + states_sql("base_events", "states") + f""",
up AS (SELECT name, max(version) AS version FROM states WHERE stage = 'Staging' GROUP BY name),
decisions AS (
  SELECT up.name, up.version, v.run_id, r.auc_roc, r.auc_roc >= {SUPPLIER_GATE}::DOUBLE passed
  FROM up JOIN versions v ON v.name = up.name AND v.version = up.version
  LEFT JOIN supplier_runs r ON r.run_id = v.run_id),
promote_events AS (
  SELECT s.name, s.version, 'Archived' stage, TIMESTAMP '{PROMOTED}' AS "at", 0 step
  FROM states s JOIN decisions d ON s.name = d.name WHERE s.stage = 'Production' AND d.passed AND s.version <> d.version
  UNION ALL SELECT name, version, 'Production', TIMESTAMP '{PROMOTED}', 1 FROM decisions WHERE passed),
after_promote AS (SELECT * FROM base_events UNION ALL SELECT * FROM promote_events)
"""


def promoted_events(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(runs, versions, base events, events added by the gated promotion)."""
    all_runs = runs_table(spark, sf)
    all_versions = versions(spark, all_runs)
    base = base_events(all_versions)
    added = registry.promote(all_versions, base, all_runs, F.lit(PROMOTED), SUPPLIER_GATE)
    return all_runs, all_versions, base, added


# --- documents ------------------------------------------------------------------------------------

DOCUMENT_SPEC = FeatureSpec(
    categorical=("lang", "source"),
    numeric=("n_chars", "n_words", "unique_ratio", "n_lines", "digit_ratio", "punct_ratio"),
    label="quality", key="doc_id")


def document_features(spark: SparkSession, sf: str, label: str | None = "quality") -> DataFrame:
    """Numbers from whole texts, made before the join so that only they are shuffled; all documents
    without a label, or those that have one."""
    docs = table(spark, sf, "documents")
    words = F.split(F.col("text"), "\\s+")
    length = F.greatest(F.length("text"), F.lit(1))

    def share(pattern: str) -> Column:
        return F.length(F.regexp_replace("text", pattern, "")) / length

    features = docs.select(
        "doc_id", "lang", "source", F.col("n_chars").cast("double").alias("n_chars"),
        F.size(words).cast("double").alias("n_words"),
        (F.size(F.array_distinct(words)) / F.size(words)).alias("unique_ratio"),
        (F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1).cast("double").alias("n_lines"),
        share("[^0-9]+").alias("digit_ratio"), share("[\\w\\s]+").alias("punct_ratio"))
    if label is None:
        return features
    labels = table(spark, sf, "labels").select(
        "doc_id", F.when(F.col(label) == 1, "Yes").when(F.col(label) == 0, "No").alias("quality"))
    return features.join(labels, "doc_id")
