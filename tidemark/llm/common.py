"""Small helpers shared by the operators."""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

ASCII_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Lower the rows per Arrow batch, so that a worker never holds thousands of long texts at once."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


@contextmanager
def short_plan_texts(spark: SparkSession, length: int = 2000):
    """Inside, Spark keeps only the head of the texts that describe plans: the driver stores one for every query, makes a
    new one after each of its stages and writes each to the event log, and with constant arrays in a plan they are long."""
    key = "spark.sql.maxPlanStringLength"
    before = spark.conf.get(key)
    spark.conf.set(key, str(length))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def arrow_input(docs: DataFrame, keep: tuple[str, ...], text: str) -> tuple[DataFrame, str, int]:
    """The kept columns as k0, k1, ..., the text if it is not among them, their schema, and the text's place."""
    cols = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)]
    place = keep.index(text) if text in keep else len(keep)
    taken = docs.select(*cols, *([] if text in keep else [F.col(text).alias("t")]))
    return taken, "".join(f"k{i} {taken.schema[f'k{i}'].dataType.simpleString()}, " for i in range(len(keep))), place


def arrow_output(batch, kept: int, added: list):
    """The first ``kept`` columns of a batch and the added ones (p0, p1, ...)."""
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([*batch.columns[:kept], *added],
                                      [*(f"k{i}" for i in range(kept)), *(f"p{i}" for i in range(len(added)))])


def fit_in_task(sample: DataFrame, fit):
    """``fit(rows)`` of a bounded, ordered sample (one partition), run by a task: neither the rows nor the arrays of the
    training take memory of the driver, which gets the model only. None where there is no row."""
    import pickle

    import pyarrow as pa

    def make(batches):
        rows = [row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns))]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(rows))], pa.binary())], ["model"])

    found = sample.mapInArrow(make, "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else None


def size_of(text: str) -> Column:
    """UTF-8 bytes of a text column; null has none."""
    return F.coalesce(F.octet_length(text).cast("long"), F.lit(0).cast("long"))


def crc_bucket(key: str, modulus: int) -> Column:
    """``crc32(key as text) mod modulus``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % modulus


def int_array(values) -> Column:
    """A constant array; the planner folds it into one literal."""
    return F.expr(f"array({','.join(f'{int(v)}L' for v in values)})")


def maybe_in(rows: DataFrame, column: str, keys: DataFrame, flag: str, most_bits: int = 1 << 27) -> DataFrame:
    """``rows`` with a boolean ``flag``: false only where ``column`` is surely not among the one-column ``keys``.

    A bitmap of hashed keys, 16 bits a key and ``most_bits`` (16 MB) at most, is sent to all tasks. It only
    saves moving rows that need no exact join; when it fills up, more rows are flagged and none is lost.
    """
    page = 1 << 15
    pages = min(most_bits // page, 16 * keys.count() // page + 1)

    def spot(name):
        return F.pmod(F.xxhash64(F.lit(5), F.col(f"`{name}`")), F.lit(pages * page))

    maps = (keys.select(spot(keys.columns[0]).alias("_h"))
            .groupBy((F.col("_h") / page).cast("long").alias("_page"))
            .agg(F.bitmap_construct_agg(F.col("_h") % page).alias("_bits")))
    bit = F.expr("(shiftright(cast(conv(hex(substring(_bits, cast(_at div 8 as int) + 1, 1)), 16, 10) as int), "
                 "cast(_at % 8 as int)) & 1) = 1")
    return (rows.withColumn("_page", (spot(column) / page).cast("long")).withColumn("_at", spot(column) % page)
            .join(F.broadcast(maps), "_page", "left").withColumn(flag, F.coalesce(bit, F.lit(False)))
            .select(*[F.col(f"`{c}`") for c in rows.columns], flag))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit values."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class WordHasher:
    """Finds the words of a byte buffer and hashes them, without a Python loop over words.

    A word is a longest run of bytes outside ``separators``. Its hash is the polynomial
    ``sum(byte[k] * BASE**k)`` modulo 2**64, taken from running sums and scrambled.
    """

    BASE = 0x9E3779B97F4A7C15
    BLOCK = 1 << 20

    def __init__(self, separators: bytes):
        self.is_word = np.ones(256, bool)
        self.is_word[list(separators)] = False
        back = pow(self.BASE, -1, 1 << 64)
        self.up, self.down = (self._powers(b, self.BLOCK + 1) for b in (self.BASE, back))

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out = np.empty(n, np.uint64)
        out[0], done = 1, 1
        while done < n:
            take = min(done, n - done)
            out[done:done + take] = out[:take] * np.uint64(pow(base, done, 1 << 64))
            done += take
        return out

    def words(self, buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end offsets of the words."""
        inside = np.zeros(len(buf) + 2, np.int8)
        inside[1:-1] = self.is_word[buf]
        edge = np.diff(inside)
        return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)

    def hash(self, buf: np.ndarray, starts: np.ndarray, *ends: np.ndarray) -> list[np.ndarray]:
        """Hashes of ``buf[starts:end]`` for each array of ends."""
        out = [np.zeros(len(starts), np.uint64) for _ in ends]
        if not len(starts):
            return out
        step = self.BLOCK // 2
        last = ends[0] if len(ends) == 1 else np.maximum.reduce(ends)
        at = 0
        while at < len(starts):
            base = int(starts[at])
            to = int(np.searchsorted(starts, base + step))
            to = max(to, at + 1)
            stop = int(last[at:to].max())
            if stop - base > self.BLOCK:  # a word longer than the block: by itself, in plain arithmetic
                to = max(at + 1, int(np.searchsorted(last, base + self.BLOCK)))
                if to == at + 1 and int(last[at]) - base > self.BLOCK:
                    for o, e in zip(out, ends):
                        o[at] = self._long(buf[base:int(e[at])])
                    at = to
                    continue
                stop = int(last[at:to].max())
            sums = np.zeros(stop - base + 1, np.uint64)
            np.cumsum(buf[base:stop] * self.up[:stop - base], out=sums[1:])
            s = starts[at:to] - base
            for o, e in zip(out, ends):
                o[at:to] = (sums[e[at:to] - base] - sums[s]) * self.down[s]
            at = to
        return [mix64(o + np.uint64(1)) for o in out]

    def _long(self, word: np.ndarray) -> int:
        total, factor = 0, 1
        for k in range(0, len(word), self.BLOCK):
            part = word[k:k + self.BLOCK]
            total += int((part * self.up[:len(part)]).sum(dtype=np.uint64)) * factor
            factor = factor * pow(self.BASE, self.BLOCK, 1 << 64) % (1 << 64)
        return total % (1 << 64)


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow string column, and the offsets of its rows; nulls are empty."""
    import pyarrow as pa

    column = column.fill_null("") if column.null_count else column
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or not len(at) or at[0] == at[-1]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]
