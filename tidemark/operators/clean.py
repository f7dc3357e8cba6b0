"""Table cleaning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.columns import col, repair_numeric


def valid_label(label: str, values: Sequence) -> Column:
    return F.col(label).isin(*values)


def filter_valid_labels(df: DataFrame, label: str, values: Sequence = ("Yes", "No")) -> DataFrame:
    """Keep rows whose label is one of ``values``; null labels are dropped."""
    return df.where(valid_label(label, values))


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.drop(*names)


def project(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*names)


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Fill missing features."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def derive_charge(df: DataFrame, rate: str, periods: str, out: str) -> DataFrame:
    """``round(rate * periods, 2)``."""
    return df.withColumn(out, F.round(col(rate) * col(periods), 2))


def clean_customers(raw: DataFrame, drop: Sequence[str] = ("customerID",),
                    total: str = "TotalCharges", label: str = "Churn",
                    values: Sequence = ("Yes", "No")) -> DataFrame:
    """Repair the text total, drop the id, keep rows with a valid label.

    A total that is neither blank nor a number becomes null; ``unparsed`` returns those rows.
    """
    return drop_columns(filter_valid_labels(raw, label, values), drop).withColumn(
        total, repair_numeric(total))


def unparsed(raw: DataFrame, numeric_text: str) -> DataFrame:
    """Quarantine: rows whose text is present, not blank and not a number, with the reason."""
    bad = F.col(numeric_text).isNotNull() & repair_numeric(numeric_text).isNull()
    return raw.where(bad).withColumn(
        "reason", F.concat(F.lit(f"{numeric_text}: not a number: "), F.col(numeric_text)))
