"""Splits, folds and samples that depend on row keys, not on partitioning."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from tidemark.functions.columns import hash32, hash_slot


def with_split(df: DataFrame, key: str, fraction: float = 0.8, seed: int = 42) -> DataFrame:
    """Add ``side`` = train or test from a hash of the key. Rows without a key fall on one side together."""
    return df.withColumn("side", F.when(hash32(key, seed) < fraction * 2 ** 32, "train").otherwise("test"))


def split(df: DataFrame, fraction: float = 0.8, seed: int = 42,
          key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Train and test side. Without a key ``randomSplit`` is used, which changes with the
    partitioning of the input."""
    if key is None:
        train, test = df.randomSplit([fraction, 1 - fraction], seed)
        return train, test
    marked = with_split(df, key, fraction, seed)
    return (marked.where(F.col("side") == "train").drop("side"),
            marked.where(F.col("side") == "test").drop("side"))


def with_folds(df: DataFrame, key: str, k: int = 3, seed: int = 42, out: str = "fold") -> DataFrame:
    """Fold number 0..k-1 from a hash of the key; rows without a key share a fold."""
    return df.withColumn(out, hash_slot(key, seed + 1, k).cast("int"))


def sample_n(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """A reproducible random sample of ``n`` rows: the smallest key hashes."""
    mark = F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed))))
    return df.withColumn("__mark", mark).orderBy("__mark", key).limit(n).drop("__mark")


@contextmanager
def cached(*frames: DataFrame) -> Iterator[tuple[DataFrame, ...]]:
    """Keep frames for repeated reading, release them afterwards; lost blocks are recomputed."""
    kept = [f.persist(StorageLevel.MEMORY_AND_DISK) for f in frames]
    try:
        yield tuple(kept)
    finally:
        for f in kept:
            f.unpersist()
