"""What-if cohorts and drift reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.monitor import INF, bound_label
from tidemark.operators.running import running_totals
from tidemark.spec import LEVELS, SCORE_BOUNDS

# The shifted cohort of brand-new, high-priced, month-to-month customers.
SHIFT_SET = {"tenure": 1, "Contract": "Month-to-month", "PaymentMethod": "Electronic check",
             "PaperlessBilling": "Yes"}
SHIFT_SCALE = {"MonthlyCharges": 3.0}


def what_if(df: DataFrame, set: Mapping[str, object] = SHIFT_SET, scale: Mapping[str, float] = SHIFT_SCALE,
            derive: Mapping[str, Column] | None = None) -> DataFrame:
    """Overwrite columns, multiply columns (two decimals), then recompute derived ones."""
    out = df.withColumns({c: F.lit(v) for c, v in set.items()})
    out = out.withColumns({c: F.round(F.col(c) * F.lit(f), 2) for c, f in scale.items()})
    return out.withColumns(dict(derive)) if derive else out


def shifted_cohort(df: DataFrame) -> DataFrame:
    """The shifted customers: total charges follow from one month at the new price."""
    return what_if(df, derive={"TotalCharges": F.round(F.col("MonthlyCharges") * F.col("tenure"), 2)})


def with_shifted(df: DataFrame) -> DataFrame:
    """Every row twice, as it is and shifted, told apart by ``cohort``; the table is read once."""
    names = df.columns
    both = shifted_cohort(df.withColumn("__base", F.struct(*names)))
    sides = F.array(
        F.struct(*[F.col(f"__base.{c}").alias(c) for c in names], F.lit("baseline").alias("cohort")),
        F.struct(*names, F.lit("shifted").alias("cohort")))
    return both.select(F.inline(sides))


def cohorts(base: DataFrame, shifted: DataFrame) -> DataFrame:
    """Two separate tables as cohorts of one."""
    return (base.withColumn("cohort", F.lit("baseline"))
            .unionByName(shifted.withColumn("cohort", F.lit("shifted"))))


def cohort_stats(scored: DataFrame, cohort: str = "cohort", score: str = "churn_probability",
                 prediction: str = "churn_prediction") -> DataFrame:
    """Scored rows, errors, churn rate in percent and mean score of each cohort; 0 without rows."""
    n = F.count(score)
    churned = F.count_if(F.col(prediction))
    return scored.groupBy(cohort).agg(
        n.alias("success"), F.count_if(F.col(score).isNull()).alias("errors"),
        F.coalesce(F.when(n > 0, 100 * churned / n), F.lit(0.0)).alias("churn_rate_pct"),
        F.coalesce(F.avg(score), F.lit(0.0)).alias("avg_probability"))


def drift_report(scored: DataFrame, cohort: str = "cohort", base: str = "baseline",
                 shifted: str = "shifted") -> DataFrame:
    """One row per measure: the two cohorts side by side and the change."""
    stats = cohort_stats(scored, cohort)
    measures = ("churn_rate_pct", "avg_probability")
    wide = stats.agg(*[F.max(F.when(F.col(cohort) == c, F.col(m))).alias(f"{m}_{i}")
                       for m in measures for i, c in enumerate((base, shifted))])
    rows = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(f"{m}_0").alias(base),
                              F.col(f"{m}_1").alias(shifted)) for m in measures])
    return wide.select(F.inline(rows)).withColumn("change", F.col(shifted) - F.col(base))


def distribution_shift(scored: DataFrame, cohort: str = "cohort", base: str = "baseline",
                       shifted: str = "shifted", score: str = "churn_probability",
                       level: str = "confidence", bounds: Sequence[float] = SCORE_BOUNDS) -> DataFrame:
    """Share of scores at or below each bound, and of each confidence level, per cohort.

    One pass: all counters of a cohort come from the same aggregate.
    """
    value = F.col(score)
    counters = [("score_le", bound_label(b), value <= F.lit(float(b))) for b in bounds]
    counters += [("score_le", INF, value.isNotNull())]
    counters += [("level", name, F.col(level) == name) for name in LEVELS]
    wide = scored.groupBy(cohort).agg(
        F.count(score).alias("__n"), *[F.count_if(c).alias(f"__{i}") for i, (_, _, c) in enumerate(counters)])
    share = {i: F.col(f"__{i}") / F.nullif(F.col("__n"), F.lit(0)) for i in range(len(counters))}
    long = wide.select(cohort, F.inline(F.array(*[
        F.struct(F.lit(kind).alias("kind"), F.lit(bucket).alias("bucket"), share[i].alias("share"))
        for i, (kind, bucket, _) in enumerate(counters)])))
    out = long.groupBy("kind", "bucket").agg(*[
        F.max(F.when(F.col(cohort) == c, F.col("share"))).alias(f"{c}_share") for c in (base, shifted)])
    return out.withColumn("change", F.col(f"{shifted}_share") - F.col(f"{base}_share"))


def progress(scored: DataFrame, order: str, every: int = 50, cohort: str = "cohort",
             score: str = "churn_probability", prediction: str = "churn_prediction",
             tiebreak: Sequence[str] = ()) -> DataFrame:
    """Running churn percentage, mean score and errors after every ``every`` rows of a cohort. Rows that may have one
    ``order`` value in large numbers need a ``tiebreak``, by which they are ordered and spread."""
    ok = F.col(score).isNotNull()
    sums = {
        "sent": F.lit(1), "success": F.when(ok, 1).otherwise(0),
        "churned": F.when(ok & F.col(prediction), 1).otherwise(0), "score": F.coalesce(score, F.lit(0)),
    }
    run = running_totals(scored.select(cohort, order, *tiebreak, score, prediction), order, sums, [cohort], tiebreak=tiebreak)
    seen = F.greatest("success_run", F.lit(1))
    return run.where(F.col("sent_run") % every == 0).select(
        cohort, F.col("sent_run").alias("sent"), F.col("sent_all").alias("total"),
        (100 * F.col("churned_run") / seen).alias("churn_pct"), (F.col("score_run").cast("double") / seen).alias("avg_score"),
        (F.col("sent_run") - F.col("success_run")).alias("errors"))
