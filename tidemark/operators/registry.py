"""Model registry as append-only tables, for all models of the tables at once.

models(name) · versions(name, version, run_id, source, description, created_at)
tags(name, version, key, value) · stage_events(name, version, stage, at, step)

The stage of a version is its last event by (at, step). One job at a time appends:
plain tables have no transactions, so version numbers have a single writer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.columns import fixed
from tidemark.operators.running import number_rows
from tidemark.operators.validate import gate
from tidemark.spec import GATE_THRESHOLD, RUN_METRICS

STAGES = ("None", "Staging", "Production", "Archived")
VERSIONS = "name string, version int, run_id string, source string, description string, created_at timestamp"
STAGE_EVENTS = "name string, version int, stage string, at timestamp, step int"
TAGS = "name string, version int, key string, value string, at timestamp"

# Metrics compared between two versions, and whether larger is better.
COMPARED = (
    ("auc_roc", True), ("accuracy", True), ("precision", True), ("recall", True),
    ("f1_score", True), ("training_duration_seconds", False),
)


def ensure_models(existing: DataFrame, names: DataFrame) -> DataFrame:
    """Model names to append: those asked for and not there yet."""
    return (names.select("name").where(F.col("name").isNotNull()).distinct()
            .join(existing.select("name"), "name", "left_anti"))


def register_versions(candidates: DataFrame, versions: DataFrame, order: str = "created_at",
                      tiebreak: Sequence[str] = ("run_id",)) -> DataFrame:
    """Version rows to append. Numbers continue after the highest version of each model."""
    last = versions.groupBy("name").agg(F.max("version").alias("__last"))
    numbered = number_rows(candidates, order, ["name"], "__n", tiebreak)
    return (numbered.join(last, "name", "left")
            .withColumn("version", (F.coalesce("__last", F.lit(0)) + F.col("__n")).cast("int"))
            .drop("__last", "__n"))


def stage_events(versions: DataFrame, stage: str, at: Column | str, step: int = 0) -> DataFrame:
    """Event rows that move the given versions to a stage."""
    if stage not in STAGES:
        raise ValueError(f"unknown stage {stage!r}; one of {', '.join(STAGES)}")
    when = F.col(at) if isinstance(at, str) else at
    return versions.select("name", "version", F.lit(stage).alias("stage"),
                           when.cast("timestamp").alias("at"), F.lit(step).alias("step"))


def registration_events(versions: DataFrame, at: str = "created_at") -> DataFrame:
    """A new version starts in None and goes straight to Staging."""
    both = F.array(F.struct(F.lit("None").alias("stage"), F.lit(0).alias("step")),
                   F.struct(F.lit("Staging").alias("stage"), F.lit(1).alias("step")))
    return versions.select("name", "version", F.col(at).cast("timestamp").alias("at"), F.inline(both)).select(
        "name", "version", "stage", "at", "step")


def tag_versions(versions: DataFrame, tags: dict[str, Column], at: Column | None = None) -> DataFrame:
    """Tag rows, one per version and key, with the time they were set; a later row replaces an earlier one."""
    when = F.current_timestamp() if at is None else at
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in tags.items()])
    return versions.select("name", "version", when.cast("timestamp").alias("at"), F.inline(pairs)).select(
        "name", "version", "key", "value", "at")


def standard_tags(algorithm: Column, auc: Column) -> dict[str, Column]:
    """Tags that follow from the run of a champion; callers add their own."""
    return {"framework": F.lit("spark_mllib"), "algorithm": algorithm, "auc_roc": fixed(auc, 4)}


def current_stages(events: DataFrame) -> DataFrame:
    """Stage of every version: its last event."""
    return events.groupBy("name", "version").agg(
        F.max_by("stage", F.struct("at", "step")).alias("stage"), F.max("at").alias("since"))


def latest_version(states: DataFrame, stage: str) -> DataFrame:
    """The highest version of each model that is in ``stage``; kept to one row per task early."""
    return (states.where(F.col("stage") == stage).groupBy("name")
            .agg(F.max("version").alias("version")).withColumn("stage", F.lit(stage)))


def version_metrics(versions: DataFrame, runs: DataFrame) -> DataFrame:
    """Each version with the metrics of its run; a version without a run keeps empty metrics."""
    return versions.join(runs, "run_id", "left")


def _candidates(versions: DataFrame, states: DataFrame, targets: DataFrame | None) -> DataFrame:
    chosen = targets.select("name", "version") if targets is not None else (
        latest_version(states, "Staging").select("name", "version"))
    return chosen.join(versions.select("name", "version", "run_id"), ["name", "version"])


def promotion_decisions(versions: DataFrame, events: DataFrame, runs: DataFrame,
                        threshold: float = GATE_THRESHOLD, force: bool = False,
                        targets: DataFrame | None = None, metric: str = "auc_roc") -> DataFrame:
    """For each model the version up for promotion, its metric and whether it passes the gate."""
    rows = _candidates(versions, current_stages(events), targets).join(
        runs.select("run_id", metric), "run_id", "left")
    rows = gate(rows.withColumn(metric, F.coalesce(metric, F.lit(0.0))), metric, threshold)
    return rows.withColumn("passed", F.lit(True)) if force else rows


def promote(versions: DataFrame, events: DataFrame, runs: DataFrame, at: Column,
            threshold: float = GATE_THRESHOLD, force: bool = False,
            targets: DataFrame | None = None) -> DataFrame:
    """Events to append: archive what is in Production, then promote what passed the gate.

    A model whose candidate fails keeps its Production version and adds no event.
    """
    passed = promotion_decisions(versions, events, runs, threshold, force, targets).where("passed")
    return _replace_production(current_stages(events), passed, at)


def _replace_production(states: DataFrame, winners: DataFrame, at: Column) -> DataFrame:
    new = winners.select("name", F.col("version").alias("__new"))
    old = (states.where(F.col("stage") == "Production").join(new, "name")
           .where(F.col("version") != F.col("__new")))
    return stage_events(old, "Archived", at, 0).unionByName(stage_events(winners, "Production", at, 1))


def previous_production(events: DataFrame) -> DataFrame:
    """The version that served before the current Production version of each model."""
    current = latest_version(current_stages(events), "Production").select(
        "name", F.col("version").alias("__current"))
    served = (events.where(F.col("stage") == "Production").groupBy("name", "version")
              .agg(F.max(F.struct("at", "step")).alias("__last")))
    return (served.join(current, "name").where(F.col("version") != F.col("__current"))
            .groupBy("name").agg(F.max_by("version", "__last").alias("version")))


def unknown_targets(events: DataFrame, targets: DataFrame) -> DataFrame:
    """Targets (name, version) that were never registered."""
    return targets.select("name", "version").join(events.select("name", "version"), ["name", "version"], "left_anti")


def rollback(events: DataFrame, at: Column, targets: DataFrame | None = None) -> DataFrame:
    """Events that archive the current version and put an earlier one back without a gate.

    ``targets`` (name, version) names the versions; without it the previous one is taken. A target that
    was never registered changes nothing; ``unknown_targets`` lists it.
    """
    known = events.select("name", "version").distinct()
    chosen = previous_production(events) if targets is None else (
        targets.select("name", "version").join(known, ["name", "version"]))
    return _replace_production(current_stages(events), chosen, at)


def production_counts(events: DataFrame) -> DataFrame:
    """Versions in Production per model; never more than one."""
    return current_stages(events).groupBy("name").agg(
        F.count_if(F.col("stage") == "Production").alias("in_production"))


def compare_versions(metrics: DataFrame, v1: int, v2: int, missing: str = "no_vote",
                     compared: Sequence[tuple[str, bool]] = COMPARED) -> DataFrame:
    """Winner of each metric between two versions, for every model that has both.

    ``metrics`` has name, version and one column per metric. With ``missing='zero'`` an
    absent metric counts as 0; otherwise a metric absent on a side gets no vote.
    """
    def side(version: int, metric: str) -> Column:
        return F.max(F.when(F.col("version") == version, F.col(metric)))

    sides = metrics.where(F.col("version").isin(v1, v2)).groupBy("name").agg(
        F.count_if(F.col("version") == v1).alias("__n1"), F.count_if(F.col("version") == v2).alias("__n2"),
        *[side(v, m).alias(f"__{i}_{m}") for i, v in ((1, v1), (2, v2)) for m, _ in compared])
    rows = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(m).alias("metric"), F.lit(up).alias("higher_is_better"),
                 F.col(f"__1_{m}").alias("v1_value"), F.col(f"__2_{m}").alias("v2_value"))
        for i, (m, up) in enumerate(compared)])
    out = sides.where("__n1 > 0 AND __n2 > 0").select("name", F.inline(rows))
    if missing == "zero":
        out = out.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("v1_value", "v2_value")})
    a, b, up = F.col("v1_value"), F.col("v2_value"), F.col("higher_is_better")
    winner = (F.when(a.isNull() | b.isNull(), "no_vote").when(a == b, "tie")
              .when((a > b) == up, f"v{v1}").otherwise(f"v{v2}"))
    return out.withColumn("winner", winner)


def comparison_verdict(comparison: DataFrame, v1: int, v2: int, states: DataFrame | None = None) -> DataFrame:
    """Votes of the two versions per model and the recommended version (null on a tie).

    With ``states`` (name, version, stage) it also says whether the winner is still to be promoted.
    """
    is_auc = F.col("metric") == "auc_roc"
    tally = comparison.groupBy("name").agg(
        F.count_if(F.col("winner") == f"v{v1}").alias("v1_wins"),
        F.count_if(F.col("winner") == f"v{v2}").alias("v2_wins"),
        F.max(F.when(is_auc, F.col("v1_value"))).alias("__auc1"),
        F.max(F.when(is_auc, F.col("v2_value"))).alias("__auc2"))
    a, b = F.col("v1_wins"), F.col("v2_wins")
    best = F.when(a > b, v1).when(b > a, v2)
    out = (tally.withColumn("score", F.concat_ws("-", a.cast("string"), b.cast("string")))
           .withColumn("winner_version", best)
           .withColumn("winner_auc", F.when(a > b, F.col("__auc1")).when(b > a, F.col("__auc2")))
           .withColumn("recommendation", F.when(best.isNull(), "tie: keep the current Production version")
                       .otherwise(F.concat(F.lit("version "), best.cast("string"),
                                           F.lit(" has better overall metrics"))))
           .drop("__auc1", "__auc2"))
    if states is None:
        return out
    live = states.select("name", F.col("version").alias("winner_version"), F.col("stage").alias("__stage"))
    return out.join(live, ["name", "winner_version"], "left").withColumn(
        "to_promote", F.col("winner_version").isNotNull() & ~F.coalesce(F.col("__stage") == "Production", F.lit(False))
    ).drop("__stage")


def model_info(versions: DataFrame, events: DataFrame, runs: DataFrame, tags: DataFrame,
               stage: str = "Production", metrics: Sequence[str] = RUN_METRICS) -> DataFrame:
    """Metadata of the version of each model in a stage: algorithm, metrics, tags, dates, text.

    Of a tag set more than once the last value counts; ``since`` is when the version came into the stage.
    """
    states = current_stages(events)
    serving = latest_version(states, stage).join(states.select("name", "version", "since"), ["name", "version"])
    latest = tags.groupBy("name", "version", "key").agg(F.max_by("value", F.struct("at", "value")).alias("value"))
    tag_map = latest.groupBy("name", "version").agg(
        F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("tags"))
    metric_map = F.map_filter(
        F.map_from_arrays(F.array(*[F.lit(m) for m in metrics]), F.array(*[F.col(m) for m in metrics])),
        lambda _, v: v.isNotNull())
    rows = (serving.join(versions, ["name", "version"]).join(runs, "run_id", "left")
            .join(tag_map, ["name", "version"], "left"))
    return rows.select(
        "name", "version", "stage", F.coalesce("algorithm", F.lit("unknown")).alias("algorithm"),
        metric_map.alias("training_metrics"), F.col("created_at").alias("registration_date"),
        F.coalesce("description", F.lit("")).alias("description"), "tags", "since")
