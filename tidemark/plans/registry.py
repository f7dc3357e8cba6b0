"""Runs, experiments, versions, stages, promotion and comparison, for every supplier's model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.columns import fixed, grid_string, prefix
from tidemark.operators import registry as reg, runs
from tidemark.operators.validate import gate as gate_operator
from tidemark.plans.catalog import query
from tidemark.plans.views import (
    DECISIONS_SQL, EVENTS_SQL, PROMOTED, ROLLED_BACK, SUPPLIER_GATE, SUPPLIER_RUNS_SQL, VERSIONS_SQL,
    base_events, empty, promoted_events, runs_table, states_sql, table, versions, with_sql,
)
from tidemark.session import work_dir
from tidemark.sources import sinks
from tidemark.spec import RUN_METRICS

RUN_COLUMNS = ["run_id", "algorithm", *RUN_METRICS]


# --- experiments and runs ---------------------------------------------------------------------------

@query("ensure_experiments", """
SELECT DISTINCT event_type AS name, md5(event_type) experiment_id FROM events
WHERE event_type NOT IN (SELECT DISTINCT event_type FROM events WHERE event_type < 'e')""")
def ensure_experiments(spark: SparkSession, sf: str) -> DataFrame:
    """Names already present add nothing; the rest get a stable id."""
    events = table(spark, sf, "events")
    first = runs.ensure_experiments(empty(spark, "name string, experiment_id string"),
                                    events.where(F.col("event_type") < "e"), "event_type")
    return runs.ensure_experiments(first, events, "event_type")


_PARAMS_SQL = SUPPLIER_RUNS_SQL.rstrip() + """,
run_params AS (
  SELECT run_id, 'algorithm' AS "key", algorithm AS "value" FROM supplier_runs
  UNION ALL SELECT run_id, 'param_grid', repeat(name || ' | ', 60) FROM supplier_runs)"""


def _params(all_runs: DataFrame) -> DataFrame:
    pairs = F.array(F.struct(F.lit("algorithm").alias("key"), F.col("algorithm").alias("value")),
                    F.struct(F.lit("param_grid").alias("key"),
                             F.repeat(F.concat("name", F.lit(" | ")), F.lit(60)).alias("value")))
    return runs.log_params(all_runs.select("run_id", F.inline(pairs)))


@query("log_params", with_sql(_PARAMS_SQL) + 'SELECT run_id, "key", "value" FROM run_params')
def log_params(spark: SparkSession, sf: str) -> DataFrame:
    return _params(runs_table(spark, sf))


@query("log_metrics", with_sql(SUPPLIER_RUNS_SQL) + " UNION ALL ".join(
    f"SELECT run_id, '{m}' AS \"key\", \"{m}\" AS \"value\" FROM supplier_runs" for m in RUN_METRICS))
def log_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics appended to a table and read back."""
    path = work_dir(spark, "run-metrics")
    sinks.append(runs.log_metrics(runs_table(spark, sf)), path)
    return spark.read.schema(runs.METRICS).parquet(path)


@query("run_states", with_sql(SUPPLIER_RUNS_SQL) + """
SELECT run_id, md5(algorithm) experiment_id, 'FINISHED' AS status, created_at started_at,
       created_at + INTERVAL 90 SECOND ended_at, 90.0::DOUBLE duration_seconds FROM supplier_runs""")
def run_states(spark: SparkSession, sf: str) -> DataFrame:
    rows = runs_table(spark, sf).withColumn("experiment_id", runs.experiment_id(F.col("algorithm")))
    events = runs.log_run(rows, "RUNNING", "created_at").unionByName(
        runs.log_run(rows, "FINISHED", F.col("created_at") + F.expr("interval 90 seconds")))
    out = runs.run_states(events)
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("started_at", "ended_at")})


_LIFE_SQL = SUPPLIER_RUNS_SQL.rstrip() + """,
lives AS (SELECT *, CASE WHEN accuracy IS NULL OR auc_roc < 0.5::DOUBLE THEN 'FAILED'
                         WHEN f1_score < 0.3::DOUBLE THEN 'RUNNING' ELSE 'FINISHED' END status FROM supplier_runs)"""


@query("run_life_cycle", with_sql(_LIFE_SQL) + """
SELECT run_id, CASE status WHEN 'RUNNING' THEN 'FAILED' ELSE status END status, created_at started_at,
       CASE status WHEN 'FAILED' THEN 'AUC below one half' WHEN 'RUNNING' THEN 'abandoned' END reason,
       CASE WHEN status <> 'RUNNING' THEN 30.0::DOUBLE END seconds_known FROM lives""")
def run_life_cycle(spark: SparkSession, sf: str) -> DataFrame:
    """Runs that finish, fail, or are left running by a job that is gone; the last are closed as abandoned."""
    rows = runs_table(spark, sf).withColumn("experiment_id", runs.experiment_id(F.col("algorithm")))
    bad = F.col("accuracy").isNull() | (F.col("auc_roc") < 0.5)
    silent = ~bad & F.coalesce(F.col("f1_score") < 0.3, F.lit(False))
    end = F.col("created_at") + F.expr("interval 30 seconds")
    events = (runs.log_run(rows, "RUNNING", "created_at")
              .unionByName(runs.log_run(rows.where(F.coalesce(bad, F.lit(False))), "FAILED", end, F.lit("AUC below one half")))
              .unionByName(runs.log_run(rows.where(~F.coalesce(bad, F.lit(False)) & ~silent), "FINISHED", end)))
    late = F.lit("2100-01-01 00:00:00").cast("timestamp")
    closed = events.unionByName(runs.abandoned(events, late))
    states = runs.run_states(closed)
    why = runs.run_failures(closed).select("run_id", "reason")
    return states.join(why, "run_id", "left").select(
        "run_id", "status", F.col("started_at").cast("timestamp_ntz").alias("started_at"), "reason",
        F.when(F.coalesce(F.col("reason") != "abandoned", F.lit(True)), F.col("duration_seconds")).alias("seconds_known"))


@query("run_view", with_sql(SUPPLIER_RUNS_SQL) + f"""
SELECT run_id, {", ".join(f'"{m}"' for m in RUN_METRICS)}, algorithm, repeat(name || ' | ', 60) param_grid
FROM supplier_runs""")
def run_view(spark: SparkSession, sf: str) -> DataFrame:
    all_runs = runs_table(spark, sf)
    return runs.run_view(runs.log_metrics(all_runs), _params(all_runs), params=("algorithm", "param_grid"))


@query("union_runs", with_sql(SUPPLIER_RUNS_SQL) + "SELECT run_id, algorithm, auc_roc FROM supplier_runs")
def union_runs(spark: SparkSession, sf: str) -> DataFrame:
    rows = runs_table(spark, sf).select("run_id", "algorithm", "auc_roc")
    names = ("Quantity Rule", "Discount Rule", "Tax Rule")
    return runs.union_runs(*[rows.where(F.col("algorithm") == n) for n in names])


@query("compare_algorithms", with_sql(SUPPLIER_RUNS_SQL) + """
SELECT run_id, algorithm, round(auc_roc, 4) auc_roc, round(accuracy, 4) accuracy, round(f1_score, 4) f1_score,
       round(training_duration_seconds, 1) AS "seconds" FROM supplier_runs""")
def compare_algorithms(spark: SparkSession, sf: str) -> DataFrame:
    return runs.compare_algorithms(runs_table(spark, sf))


@query("champion", with_sql(SUPPLIER_RUNS_SQL) + """
SELECT name, run_id, algorithm, logged_order, auc_roc FROM supplier_runs
QUALIFY row_number() OVER (PARTITION BY name ORDER BY auc_roc DESC, logged_order) = 1""")
def champion(spark: SparkSession, sf: str) -> DataFrame:
    rows = runs_table(spark, sf).select("name", "run_id", "algorithm", "logged_order", "auc_roc")
    return runs.champion(rows, ["name"])


@query("describe_run", with_sql(VERSIONS_SQL) + "SELECT run_id, description FROM versions")
def describe_run(spark: SparkSession, sf: str) -> DataFrame:
    return runs_table(spark, sf).select("run_id", runs.describe_run(*[F.col(c) for c in (
        "algorithm", "auc_roc", "accuracy", "f1_score", "training_duration_seconds")]).alias("description"))


@query("model_summary", with_sql(SUPPLIER_RUNS_SQL) + """
SELECT algorithm, run_id, auc_roc, accuracy, f1_score, training_duration_seconds training_seconds, 6 pipeline_stages
FROM supplier_runs""")
def model_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Summary rows written as JSON and read back."""
    path = work_dir(spark, "summaries")
    sinks.write_json(runs.model_summary(runs_table(spark, sf), 6), path)
    return spark.read.schema("algorithm string, run_id string, auc_roc double, accuracy double, f1_score double, "
                             "training_seconds double, pipeline_stages int").json(path)


@query("grid_string", with_sql(SUPPLIER_RUNS_SQL) + """
SELECT run_id, 'order=' || CAST(logged_order AS VARCHAR) || ', threshold=0.5 | order=' || CAST(logged_order AS VARCHAR) || ', threshold=0.6' grid
FROM supplier_runs""")
def grid_text(spark: SparkSession, sf: str) -> DataFrame:
    order = F.col("logged_order").cast("string")
    points = F.array(*[F.create_map(F.lit("threshold"), F.lit(t), F.lit("order"), order) for t in ("0.5", "0.6")])
    return runs_table(spark, sf).select("run_id", grid_string(points).alias("grid"))


@query("short_run_ids", with_sql(SUPPLIER_RUNS_SQL) + """
SELECT run_id, substr(md5(run_id), 1, 8) id8, substr(md5(run_id), 1, 12) id12, printf('%.6f', round(auc_roc, 6)) auc6 FROM supplier_runs""")
def short_run_ids(spark: SparkSession, sf: str) -> DataFrame:
    return runs_table(spark, sf).select(
        "run_id", prefix(F.md5("run_id"), 8).alias("id8"), prefix(F.md5("run_id"), 12).alias("id12"),
        fixed("auc_roc", 6).alias("auc6"))


# --- registry -----------------------------------------------------------------------------------------

@query("ensure_models", with_sql(SUPPLIER_RUNS_SQL) + """
SELECT DISTINCT name FROM supplier_runs WHERE name NOT IN (SELECT name FROM supplier_runs WHERE auc_roc >= 0.55::DOUBLE)""")
def ensure_models(spark: SparkSession, sf: str) -> DataFrame:
    """Names of models with a good run exist already; the others are to be created."""
    rows = runs_table(spark, sf)
    existing = reg.ensure_models(empty(spark, "name string"), rows.where(F.col("auc_roc") >= 0.55))
    return reg.ensure_models(existing, rows)


@query("register_versions", with_sql(VERSIONS_SQL) + "SELECT name, version, run_id, source, description FROM versions")
def register_versions(spark: SparkSession, sf: str) -> DataFrame:
    return versions(spark, runs_table(spark, sf)).select("name", "version", "run_id", "source", "description")


@query("register_more_versions", with_sql(VERSIONS_SQL) + """
SELECT name, (version + 3)::INTEGER AS version, run_id FROM versions""")
def register_more_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Registering the same runs again continues the numbering."""
    first = versions(spark, runs_table(spark, sf))
    again = first.select("name", "run_id", "source", "description", "created_at")
    return reg.register_versions(again, first).select("name", "version", "run_id")


@query("tag_versions", with_sql(VERSIONS_SQL.rstrip() + """,
tagged AS (SELECT v.name, v.version, r.algorithm, printf('%.4f', round(r.auc_roc, 4)) auc FROM versions v JOIN supplier_runs r USING (run_id))""") + """
SELECT name, version, 'owner' AS "key", name AS "value" FROM tagged
UNION ALL SELECT name, version, 'framework', 'spark_mllib' FROM tagged
UNION ALL SELECT name, version, 'algorithm', algorithm FROM tagged
UNION ALL SELECT name, version, 'auc_roc', auc FROM tagged""")
def tag_versions(spark: SparkSession, sf: str) -> DataFrame:
    all_runs = runs_table(spark, sf)
    return _tags(versions(spark, all_runs), all_runs).drop("at")


def _tags(mine: DataFrame, all_runs: DataFrame) -> DataFrame:
    rows = mine.join(all_runs.select("run_id", "algorithm", "auc_roc"), "run_id")
    own = {"owner": F.col("name"), **reg.standard_tags(F.col("algorithm"), F.col("auc_roc"))}
    return reg.tag_versions(rows, own, F.col("created_at"))


@query("retag_versions", with_sql(VERSIONS_SQL) + """
SELECT name, version, name || ' (new)' AS tag_owner, printf('%.4f', round(r.auc_roc, 4)) tag_auc
FROM versions v JOIN supplier_runs r USING (run_id, name) WHERE version = 3""")
def retag_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Tags set a second time replace the first ones; the others stay."""
    all_runs = runs_table(spark, sf)
    mine = versions(spark, all_runs)
    again = reg.tag_versions(mine, {"owner": F.concat("name", F.lit(" (new)"))}, F.col("created_at") + F.expr("interval 1 day"))
    info = reg.model_info(mine, base_events(mine), all_runs.drop("name", "created_at"), _tags(mine, all_runs).unionByName(again),
                          "Staging")
    return info.where("version = 3").select("name", "version", F.col("tags")["owner"].alias("tag_owner"),
                                            F.col("tags")["auc_roc"].alias("tag_auc"))


@query("rollback_unknown", with_sql(DECISIONS_SQL.rstrip()) + """
SELECT name, 99 AS version FROM decisions WHERE passed""")
def rollback_unknown(spark: SparkSession, sf: str) -> DataFrame:
    """Targets that name no version change nothing and are reported."""
    _, _, base, added = promoted_events(spark, sf)
    events = base.unionByName(added)
    targets = added.where("stage = 'Production'").select("name", F.lit(99).alias("version"))
    untouched = reg.rollback(events, F.lit(ROLLED_BACK), targets).select("name", "version")
    return reg.unknown_targets(events, targets).unionByName(untouched)


@query("current_stages", with_sql(EVENTS_SQL.rstrip() + "," + states_sql("base_events", "states")) + "SELECT * FROM states")
def current_stages(spark: SparkSession, sf: str) -> DataFrame:
    return reg.current_stages(base_events(versions(spark, runs_table(spark, sf)))).withColumn("since", F.col("since").cast("timestamp_ntz"))


@query("latest_version", with_sql(EVENTS_SQL.rstrip() + "," + states_sql("base_events", "states")) + """
SELECT name, max(version) AS version, stage FROM states WHERE stage = 'Staging' GROUP BY name, stage""")
def latest_version(spark: SparkSession, sf: str) -> DataFrame:
    return reg.latest_version(reg.current_stages(base_events(versions(spark, runs_table(spark, sf)))), "Staging")


@query("version_metrics", with_sql(VERSIONS_SQL) + """
SELECT v.name, v.version, v.run_id, r.algorithm, r.auc_roc, r.accuracy FROM versions v LEFT JOIN supplier_runs r USING (run_id)""")
def version_metrics(spark: SparkSession, sf: str) -> DataFrame:
    all_runs = runs_table(spark, sf)
    return reg.version_metrics(versions(spark, all_runs), all_runs.select("run_id", "algorithm", "auc_roc", "accuracy")).select(
        "name", "version", "run_id", "algorithm", "auc_roc", "accuracy")


@query("gate", with_sql(SUPPLIER_RUNS_SQL) + f"SELECT run_id, auc_roc, auc_roc >= {SUPPLIER_GATE}::DOUBLE passed FROM supplier_runs")
def gate(spark: SparkSession, sf: str) -> DataFrame:
    return gate_operator(runs_table(spark, sf).select("run_id", "auc_roc"), "auc_roc", SUPPLIER_GATE)


@query("promotion_decisions", with_sql(DECISIONS_SQL) + "SELECT name, version, run_id, auc_roc, passed FROM decisions")
def promotion_decisions(spark: SparkSession, sf: str) -> DataFrame:
    all_runs = runs_table(spark, sf)
    mine = versions(spark, all_runs)
    return reg.promotion_decisions(mine, base_events(mine), all_runs, SUPPLIER_GATE)


def _shown(events: DataFrame) -> DataFrame:
    return events.withColumn("at", F.col("at").cast("timestamp_ntz"))


@query("promote", with_sql(DECISIONS_SQL) + 'SELECT name, version, stage, "at", step FROM promote_events')
def promote(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(promoted_events(spark, sf)[3])


@query("promote_forced", with_sql(DECISIONS_SQL) + f"""
SELECT name, 1 AS version, 'Archived' AS stage, TIMESTAMP '{PROMOTED}' AS "at", 0 step FROM up
UNION ALL SELECT name, version, 'Production', TIMESTAMP '{PROMOTED}', 1 FROM up""")
def promote_forced(spark: SparkSession, sf: str) -> DataFrame:
    """Without the gate every model's latest staged version goes live."""
    all_runs = runs_table(spark, sf)
    mine = versions(spark, all_runs)
    return _shown(reg.promote(mine, base_events(mine), all_runs, F.lit(PROMOTED), force=True))


@query("production_counts", with_sql(DECISIONS_SQL.rstrip() + "," + states_sql("after_promote", "now")) + """
SELECT name, count(*) FILTER (WHERE stage = 'Production') in_production FROM now GROUP BY name""")
def production_counts(spark: SparkSession, sf: str) -> DataFrame:
    _, _, base, added = promoted_events(spark, sf)
    return reg.production_counts(base.unionByName(added))


@query("rollback", with_sql(DECISIONS_SQL.rstrip()) + f"""
SELECT name, version, 'Archived' AS stage, TIMESTAMP '{ROLLED_BACK}' AS "at", 0 step FROM decisions WHERE passed
UNION ALL SELECT name, 1, 'Production', TIMESTAMP '{ROLLED_BACK}', 1 FROM decisions WHERE passed""")
def rollback(spark: SparkSession, sf: str) -> DataFrame:
    """Models that were promoted go back to the version that served before."""
    _, _, base, added = promoted_events(spark, sf)
    return _shown(reg.rollback(base.unionByName(added), F.lit(ROLLED_BACK)))


@query("model_info", with_sql(DECISIONS_SQL.rstrip() + "," + states_sql("after_promote", "now")) + """
SELECT n.name, n.version, n.stage, r.algorithm, r.auc_roc, r.f1_score, v.created_at registration_date, v.description,
       n.name AS tag_owner, printf('%.4f', round(r.auc_roc, 4)) tag_auc
FROM now n JOIN versions v ON v.name = n.name AND v.version = n.version JOIN supplier_runs r ON r.run_id = v.run_id
WHERE n.stage = 'Production'""")
def model_info(spark: SparkSession, sf: str) -> DataFrame:
    all_runs, mine, base, added = promoted_events(spark, sf)
    tags = _tags(mine, all_runs)
    info = reg.model_info(mine, base.unionByName(added), all_runs.drop("name", "created_at"), tags)
    return info.select("name", "version", "stage", "algorithm", F.col("training_metrics")["auc_roc"].alias("auc_roc"),
                       F.col("training_metrics")["f1_score"].alias("f1_score"),
                       F.col("registration_date").cast("timestamp_ntz").alias("registration_date"), "description",
                       F.col("tags")["owner"].alias("tag_owner"), F.col("tags")["auc_roc"].alias("tag_auc"))


# --- comparison -----------------------------------------------------------------------------------------

def _compared_sql(zero: bool) -> str:
    def val(v: str, m: str) -> str:
        c = f'{v}."{m}"'
        # the second version has lost its recorded F1 score
        c = "NULL::DOUBLE" if v == "b" and m == "f1_score" else c
        return f"coalesce({c}, 0.0::DOUBLE)" if zero else c
    rows = " UNION ALL ".join(
        f"SELECT a.name, {i} AS \"position\", '{m}' metric, {str(up).upper()} higher_is_better, {val('a', m)} v1_value, {val('b', m)} v2_value "
        "FROM supplier_runs a JOIN supplier_runs b ON a.name = b.name AND a.logged_order = 1 AND b.logged_order = 2"
        for i, (m, up) in enumerate(reg.COMPARED))
    return SUPPLIER_RUNS_SQL.rstrip() + f""",
sides AS ({rows}),
compared AS (
  SELECT *, CASE WHEN v1_value IS NULL OR v2_value IS NULL THEN 'no_vote' WHEN v1_value = v2_value THEN 'tie'
                 WHEN (v1_value > v2_value) = higher_is_better THEN 'v1' ELSE 'v2' END winner FROM sides)"""


def _comparison(all_runs: DataFrame, missing: str) -> DataFrame:
    rows = all_runs.withColumn("version", F.col("logged_order"))
    rows = rows.withColumn("f1_score", F.when(F.col("version") != 2, F.col("f1_score")))
    return reg.compare_versions(rows, 1, 2, missing)


@query("compare_versions", with_sql(_compared_sql(False)) + "SELECT * FROM compared")
def compare_versions(spark: SparkSession, sf: str) -> DataFrame:
    return _comparison(runs_table(spark, sf), "no_vote")


@query("compare_versions_zero", with_sql(_compared_sql(True)) + "SELECT * FROM compared")
def compare_versions_zero(spark: SparkSession, sf: str) -> DataFrame:
    return _comparison(runs_table(spark, sf), "zero")


@query("comparison_verdict", with_sql(_compared_sql(False) + """,
tally AS (SELECT name, count(*) FILTER (WHERE winner = 'v1') v1_wins, count(*) FILTER (WHERE winner = 'v2') v2_wins,
                 max(v1_value) FILTER (WHERE metric = 'auc_roc') auc1, max(v2_value) FILTER (WHERE metric = 'auc_roc') auc2
          FROM compared GROUP BY name)""") + """
SELECT name, v1_wins, v2_wins, CAST(v1_wins AS VARCHAR) || '-' || CAST(v2_wins AS VARCHAR) score,
       CASE WHEN v1_wins > v2_wins THEN 1 WHEN v2_wins > v1_wins THEN 2 END winner_version,
       CASE WHEN v1_wins > v2_wins THEN auc1 WHEN v2_wins > v1_wins THEN auc2 END winner_auc,
       CASE WHEN v1_wins > v2_wins THEN 'version 1 has better overall metrics' WHEN v2_wins > v1_wins THEN 'version 2 has better overall metrics'
            ELSE 'tie: keep the current Production version' END recommendation,
       v2_wins > v1_wins AS to_promote FROM tally""")
def comparison_verdict(spark: SparkSession, sf: str) -> DataFrame:
    """Version 1 serves everywhere, so only a winning version 2 is still to be promoted."""
    all_runs = runs_table(spark, sf)
    states = reg.current_stages(base_events(versions(spark, all_runs)))
    return reg.comparison_verdict(_comparison(all_runs, "no_vote"), 1, 2, states)
