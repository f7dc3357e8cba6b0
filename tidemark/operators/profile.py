"""Profiling: class shares, missing values, numeric summaries, samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.columns import is_missing, percentage
from tidemark.spec import FeatureSpec, categorical_columns


def _long(wide: DataFrame, names: Sequence[str], parts: Sequence[str], key: str) -> DataFrame:
    """One row of ``name|part`` columns to one row per name."""
    entries = [F.struct(F.lit(n).alias(key), *[F.col(f"`{n}|{p}`").alias(p) for p in parts]) for n in names]
    return wide.select(F.inline(F.array(*entries)))


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows and percentage of each label value; the total is summed from the counts."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("percentage", percentage(F.col("count"), total))


def missing_counts(df: DataFrame) -> DataFrame:
    """Null or empty values of every column, in one pass."""
    names = df.columns
    wide = df.agg(*[F.count_if(is_missing(f.name, f.dataType.typeName())).alias(f"{f.name}|missing")
                    for f in df.schema.fields])
    return _long(wide, names, ["missing"], "column_name")


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample standard deviation, minimum and maximum, in one pass."""
    aggs = []
    for c in columns:
        v = F.col(c).cast("double")
        aggs += [F.count(v).alias(f"{c}|count"), F.avg(v).alias(f"{c}|mean"),
                 F.stddev_samp(v).alias(f"{c}|stddev"), F.min(v).alias(f"{c}|min"),
                 F.max(v).alias(f"{c}|max")]
    return _long(df.agg(*aggs), columns, ["count", "mean", "stddev", "min", "max"], "column_name")


def sample_rows(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in a stated order (a top-n, not a full sort)."""
    return df.orderBy(*order_by).limit(n)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def exploration_summary(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """The profile as (section, name, value) text rows: totals, classes, missing, columns.

    One pass: everything is counted per label value, and those few rows make up the rest.
    """
    per_class = df.groupBy(spec.label).agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.count_if(is_missing(f.name, f.dataType.typeName())).alias(f"__{i}") for i, f in enumerate(df.schema.fields)])
    whole = per_class.agg(
        F.sum("__n").alias("n"), F.collect_list(F.struct(F.col(spec.label).alias("label"), F.col("__n").alias("n"))).alias("classes"),
        *[F.sum(f"__{i}").alias(f"__{i}") for i in range(len(df.columns))])

    def row(section: str, name: str, value: Column | str) -> Column:
        text = F.lit(value) if isinstance(value, str) else value.cast("string")
        return F.struct(F.lit(section).alias("section"), F.lit(name).alias("name"), text.alias("value"))

    fixed_rows = F.array(
        row("total", "rows", F.coalesce("n", F.lit(0))), row("total", "columns", str(len(df.columns))),
        row("columns", "all", ", ".join(df.columns)), row("columns", "numeric", ", ".join(spec.numeric)),
        row("columns", "categorical", ", ".join(categorical_columns(df.columns, spec))),
        *[row("missing", c, F.coalesce(f"__{i}", F.lit(0))) for i, c in enumerate(df.columns)])
    class_rows = F.transform("classes", lambda c: F.struct(
        F.lit("class").alias("section"), c["label"].cast("string").alias("name"),
        F.format_string("%d (%.2f%%)", c["n"], percentage(c["n"], F.col("n"))).alias("value")))
    return whole.select(F.inline(F.concat(fixed_rows, class_rows)))
