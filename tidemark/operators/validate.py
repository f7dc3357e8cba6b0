"""Row validation: every field error of a row, collected into one text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.spec import CUSTOMER_FIELDS, LEVELS, MAX_BATCH, Field

_TYPE_WORDS = {"int": "integer", "double": "number"}


def _listed(values: Sequence) -> str:
    shown = [f"'{v}'" if isinstance(v, str) else str(v) for v in values]
    return shown[0] if len(shown) == 1 else ", ".join(shown[:-1]) + " or " + shown[-1]


def _number(v: float) -> str:
    return f"{v:g}"


def field_error(field: Field, dtype: T.DataType) -> Column:
    """Message of the first failed check of one field, or null."""
    c = F.col(field.name)
    checks: list[tuple[Column, str]] = []
    if field.required:
        checks.append((c.isNull(), "Field required"))
    value = c
    if field.type != "string" and isinstance(dtype, T.StringType):
        value = c.try_cast(field.type)
        checks.append((c.isNotNull() & value.isNull(), f"Input should be a valid {_TYPE_WORDS[field.type]}"))
    if field.allowed is not None:
        checks.append((~value.isin(*field.allowed), f"Input should be {_listed(field.allowed)}"))
    if field.ge is not None:
        checks.append((value < field.ge, f"Input should be greater than or equal to {_number(field.ge)}"))
    if field.gt is not None:
        checks.append((value <= field.gt, f"Input should be greater than {_number(field.gt)}"))
    if field.le is not None:
        checks.append((value > field.le, f"Input should be less than or equal to {_number(field.le)}"))
    out = None
    for failed, message in checks:
        text = F.lit(f"{field.name}: {message}")
        out = F.when(failed, text) if out is None else out.when(failed, text)
    return out if out is not None else F.lit(None).cast("string")


def validate(df: DataFrame, fields: Sequence[Field] = CUSTOMER_FIELDS) -> DataFrame:
    """Append ``errors`` (array), ``detail`` (one text) and ``status``."""
    types = {f.name: f.dataType for f in df.schema.fields}
    errors = F.array_compact(F.array(*[field_error(f, types[f.name]) for f in fields]))
    return (df.withColumn("errors", errors)
            .withColumn("detail", F.array_join("errors", "; "))
            .withColumn("status", F.when(F.size("errors") == 0, "valid").otherwise("invalid")))


def typed(df: DataFrame, fields: Sequence[Field] = CUSTOMER_FIELDS) -> DataFrame:
    """Cast text fields to their declared types; text that does not parse becomes null."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({
        f.name: F.col(f.name).try_cast(f.type) for f in fields
        if f.type != "string" and isinstance(types[f.name], T.StringType)})


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted rows without the check columns, and the quarantine with them."""
    ok = validated.where(F.col("status") == "valid").drop("errors", "detail", "status")
    return ok, validated.where(F.col("status") == "invalid")


def check_batch_sizes(df: DataFrame, batch: str, low: int = 1, high: int = MAX_BATCH) -> DataFrame:
    """Rows per batch, and whether that is within the allowed range."""
    return (df.groupBy(batch).agg(F.count(F.lit(1)).alias("batch_size"))
            .withColumn("accepted", F.col("batch_size").between(low, high)))


def reject_large(validated: DataFrame, size: str, high: int = MAX_BATCH) -> DataFrame:
    """Rows whose batch, of ``size`` rows, is too large become invalid, with an error of their own after the others.
    Rows without a size belong to no batch and are left as they are."""
    message = F.when(F.col(size) > high, F.concat(F.lit("batch: "), F.col(size).cast("string"), F.lit(f" rows, at most {high} allowed")))
    errors = F.array_compact(F.concat("errors", F.array(message)))
    return (validated.withColumn("errors", errors).withColumn("detail", F.array_join("errors", "; "))
            .withColumn("status", F.when(F.size("errors") == 0, "valid").otherwise("invalid")))


def with_batch_limit(validated: DataFrame, batch: str, high: int = MAX_BATCH) -> DataFrame:
    """The same for rows that name their ``batch``: sizes are counted before the shuffle and only batches that are too
    large are joined back. A null batch is no batch. Reads its input twice."""
    large = (check_batch_sizes(validated, batch, 0, high).where("NOT accepted")
             .select(F.col(batch).alias("__batch"), F.col("batch_size").alias("__size")))
    joined = validated.join(large, validated[batch] == large["__batch"], "left")
    return reject_large(joined, "__size", high).drop("__batch", "__size")


def check_list_sizes(df: DataFrame, list_field: str, low: int = 1, high: int = MAX_BATCH) -> DataFrame:
    """The same check on batches that arrive as arrays; an empty or missing list is rejected."""
    size = F.coalesce(F.size(list_field), F.lit(0))
    return df.withColumn("batch_size", F.greatest(size, F.lit(0))).withColumn(
        "accepted", F.col("batch_size").between(low, high))


def check_scores(scored: DataFrame, score: str = "churn_probability", level: str = "confidence") -> DataFrame:
    """Count scored rows outside [0, 1] or with an unknown level."""
    return scored.agg(
        F.count(score).alias("rows_scored"),
        F.count_if((F.col(score) < 0) | (F.col(score) > 1)).alias("score_out_of_range"),
        F.count_if(F.col(score).isNotNull() & ~F.coalesce(F.col(level).isin(*LEVELS), F.lit(False)))
        .alias("unknown_level"))


def gate(df: DataFrame, metric: str, threshold: float = 0.80, out: str = "passed") -> DataFrame:
    """``metric >= threshold``; a missing metric does not pass."""
    return df.withColumn(out, F.coalesce(F.col(metric) >= F.lit(threshold), F.lit(False)))
