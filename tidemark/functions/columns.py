"""Column expressions shared by the operators. All stay inside generated code."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def repair_numeric(c: Column | str, blank: float = 0.0) -> Column:
    """Text to double: blank text becomes ``blank``, text that is no number becomes null."""
    c = col(c)
    return F.when(F.trim(c) == "", F.lit(float(blank))).otherwise(c.try_cast("double"))


def exact_sum(c: Column | str) -> Column:
    """Aggregate: sum of doubles as the decimals they are written with, the same in any order of the rows. A value that
    no decimal(38,10) holds (NaN, infinite, huge) makes it the plain sum of doubles."""
    c = col(c)
    exact = c.try_cast("decimal(38,10)")
    return F.coalesce(F.when(F.count(exact) == F.count(c), F.try_sum(exact).cast("double")), F.sum(c))


def is_missing(c: Column | str, dtype: str) -> Column:
    """Null, or empty when the column holds text."""
    c = col(c)
    return c.isNull() | (c == "") if dtype == "string" else c.isNull()


def percentage(part: Column, whole: Column, places: int = 2) -> Column:
    return F.round(part / whole * F.lit(100), places)


def positive_score(probability: Column | str = "probability") -> Column:
    """Probability of the positive class from a two-class probability vector."""
    return F.element_at(vector_to_array(col(probability)), 2)


def decide(score: Column | str, threshold: float = 0.5) -> Column:
    return col(score) >= F.lit(threshold)


def round_score(score: Column | str) -> Column:
    return F.round(col(score), 4)


def confidence_level(score: Column | str, high: float = 0.3, medium: float = 0.15) -> Column:
    """Band a score by its distance from the decision boundary 0.5."""
    distance = F.abs(col(score) - F.lit(0.5))
    return (F.when(distance >= high, F.lit("high"))
            .when(distance >= medium, F.lit("medium"))
            .when(distance.isNotNull(), F.lit("low")))


def clamp(c: Column | str, low: float = 0.01, high: float = 0.99) -> Column:
    """Restrict to [low, high]; null stays null."""
    c = col(c)
    return F.when(c.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), c)))


def noise(amount: float, seed: int | None = None) -> Column:
    """Uniform noise in [-amount, amount)."""
    return F.rand(seed) * F.lit(2 * amount) - F.lit(amount)


def bool_label(c: Column | str) -> Column:
    return col(c).cast("string")


def status_band(value: Column | str, yellow: float, red: float) -> Column:
    """Traffic light for a measured value with two absolute limits."""
    value = col(value)
    return (F.when(value >= red, F.lit("red"))
            .when(value >= yellow, F.lit("yellow"))
            .when(value.isNotNull(), F.lit("green")))


def hash32(key: Column | str, seed: int) -> Column:
    """A number from 0 to 2**32 - 1 that depends only on key and seed, never on partitioning. All null
    keys share one number."""
    digest = F.md5(F.concat(F.coalesce(col(key).cast("string"), F.lit("(null)")), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def hash_slot(key: Column | str, seed: int, slots: int) -> Column:
    """Slot 0..slots-1 of a key."""
    return hash32(key, seed) % F.lit(slots)


def prefix(c: Column | str, n: int) -> Column:
    return F.substring(col(c), 1, n)


def fixed(c: Column | str, places: int) -> Column:
    """Number as text with a fixed count of decimals."""
    return F.format_string(f"%.{places}f", col(c))


def _micros(start: Column | str, end: Column | str) -> Column:
    return F.unix_micros(col(end).cast("timestamp")) - F.unix_micros(col(start).cast("timestamp"))


def elapsed_seconds(start: Column | str, end: Column | str, places: int = 3) -> Column:
    """Seconds between two timestamps."""
    return F.round(_micros(start, end) / F.lit(1_000_000), places)


def elapsed_ms(start: Column | str, end: Column | str, places: int = 2) -> Column:
    """Milliseconds between two timestamps."""
    return F.round(_micros(start, end) / F.lit(1000), places)


def grid_string(grid: Column | str) -> Column:
    """``array<map<string,string>>`` to ``a=1, b=2 | a=1, b=3``, parameters sorted by name."""
    return F.array_join(
        F.transform(col(grid), lambda point: F.array_join(
            F.transform(F.array_sort(F.map_entries(point)), lambda e: F.concat_ws("=", e["key"], e["value"])), ", ")),
        " | ")
