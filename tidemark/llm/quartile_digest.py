"""Document fingerprints: a digest of bucket quartiles over hashed byte triplets.

Every triplet of neighbouring bytes counts in one of ``BUCKETS`` buckets. The digest gives each bucket
two bits, its quartile among all counts, and begins with the logarithm of the length and the ratios
of the quartile bounds. Small changes to a text move few buckets to a neighbouring quartile, so two
digests differ by a bounded score: bucket steps, plus steps of length and ratios.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import small_batches
from tidemark.sources.sinks import materialize

BUCKETS = 256
LENGTH_STEPS, RATIO_STEPS = 24, 7
#: Largest difference score: three steps a bucket, and the header's.
MOST = 3 * BUCKETS + LENGTH_STEPS + 2 * RATIO_STEPS
_AT_ONCE = 1 << 20


def counts(data: np.ndarray) -> np.ndarray:
    """Triplets per bucket; very long texts are counted piece by piece."""
    out = np.zeros(BUCKETS, np.int64)
    for at in range(0, max(0, len(data) - 2), _AT_ONCE):
        part = data[at:at + _AT_ONCE + 2].astype(np.uint32)
        mixed = part[:-2] * np.uint32(0x9E3779B1) ^ part[1:-1] * np.uint32(0x85EBCA77) ^ part[2:] * np.uint32(0xC2B2AE3D)
        out += np.bincount((mixed * np.uint32(0x27D4EB2F)) >> np.uint32(24), minlength=BUCKETS)
    return out


def fingerprint(data: bytes) -> str:
    """Hex digest of UTF-8 bytes: two digits of length, two of ratios, and four buckets in every two digits."""
    found = counts(np.frombuffer(data, np.uint8))
    low, mid, high = np.sort(found)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    codes = (found > low).astype(np.uint8) + (found > mid) + (found > high)
    length = int(8 * np.log2(len(data) + 1)) % 256
    ratios = (int(8 * low // high) if high else 0) % 8 << 4 | (int(8 * mid // high) if high else 0) % 8
    packed = codes.reshape(-1, 4) @ np.array([64, 16, 4, 1], np.uint8)
    return bytes([length, ratios]).hex() + packed.astype(np.uint8).tobytes().hex()


def _codes(digests: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(bytes.fromhex("".join(digests)), np.uint8).reshape(len(digests), -1)
    body = raw[:, 2:]
    return raw[:, :2].astype(np.int16), np.stack([body >> 6, body >> 4 & 3, body >> 2 & 3, body & 3], axis=2).astype(np.int8)


def difference(a: list[str], b: list[str]) -> np.ndarray:
    """Difference score of digests pair by pair, from 0 (equal) to MOST."""
    if not a:
        return np.zeros(0, np.int64)
    (ha, ca), (hb, cb) = _codes(a), _codes(b)
    steps = np.abs(ca - cb).sum(axis=(1, 2), dtype=np.int64)
    size = np.minimum(np.abs(ha[:, 0] - hb[:, 0]), LENGTH_STEPS)
    ratios = np.abs((ha[:, 1] >> 4) - (hb[:, 1] >> 4)) + np.abs((ha[:, 1] & 15) - (hb[:, 1] & 15))
    return steps + size + ratios


def likeness(a: list[str], b: list[str]) -> np.ndarray:
    """1 for equal digests, falling to 0 with the difference score."""
    return 1 - difference(a, b) / MOST


def edited(text: str, following: str) -> str:
    """``text`` with its last floor(n / 2) characters replaced by the first as many (or all) of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def fingerprint_texts(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and the fingerprint of every whole text; null counts as empty."""
    import pyarrow as pa

    from tidemark.llm.common import arrow_input, arrow_output

    small_batches(docs.sparkSession)
    taken, schema, place = arrow_input(docs, keep, text)

    def make(batches):
        for batch in batches:
            yield arrow_output(batch, len(keep), [pa.array(
                [fingerprint((t or "").encode("utf-8", "surrogatepass")) for t in batch.column(place).to_pylist()], pa.string())])

    return taken.mapInArrow(make, schema + "p0 string").toDF(*keep, "fingerprint")


def compare_with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's fingerprint, that of its edited text, and the likeness of both and of the next document's.

    The next document is the next in descending order of the key (null keys come last, equal keys are
    ordered by their texts); after the last comes the first. Texts meet their successors in one pass:
    rows are sorted into ranges, each range is read once, and only the first and last row of a range are
    kept aside, matched in a second small step. Null texts are empty; a single document follows itself;
    an empty table gives no rows; other columns are not read.
    """
    import pyarrow as pa
    from pyspark import TaskContext

    spark = docs.sparkSession
    small_batches(spark)
    taken = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    # the second column only breaks ties, and lets a key that very many rows share run over several ranges
    order = [F.col("k").desc_nulls_last(), F.xxhash64("t").asc()]
    ranged = taken.repartitionByRange(*order).sortWithinPartitions(*order, "t")
    kind = taken.schema["k"].dataType.simpleString()
    columns = ["k", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [None, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def results(rows, key_type):
        near = likeness([r[3] for r in rows], [r[4] for r in rows]), likeness([r[3] for r in rows], [r[5] for r in rows])
        data = [[r[i] for r in rows] for i in range(5)]
        return [pa.array(c, t or key_type) for c, t in zip([*data, near[0].tolist(), near[1].tolist()], types)]

    def row(this, after):
        changed = edited(this[1], after[1]).encode("utf-8", "surrogatepass")
        return (this[0], len(this[1]), hashlib.sha256(changed).hexdigest(), this[2], fingerprint(changed), after[2])

    def walk(batches):
        part = TaskContext.get().partitionId()
        before = first = None
        key_type = None
        names = [*columns, "part", "edge", "text"]

        def edge(which, doc):
            return pa.RecordBatch.from_arrays([
                pa.array([doc[0]], key_type), pa.array([None], types[1]), pa.array([None], types[2]),
                pa.array([doc[2]], types[3]), *[pa.array([None], t) for t in types[4:]], pa.array([part], pa.int32()),
                pa.array([which], pa.int32()), pa.array([doc[1]], pa.string())], names)

        for batch in batches:
            key_type = batch.column(0).type
            out = []
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                doc = (k, t, fingerprint(t.encode("utf-8", "surrogatepass")))
                if before is None:
                    first = doc
                else:
                    out.append(row(before, doc))
                before = doc
            if out:
                yield pa.RecordBatch.from_arrays([*results(out, key_type), pa.array([part] * len(out), pa.int32()),
                                                  pa.array([0] * len(out), pa.int32()), pa.array([None] * len(out), pa.string())], names)
        if before is not None:
            yield edge(1, first)
            yield edge(2, before)

    schema = (f"k {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    walked = materialize(ranged.mapInArrow(walk, schema + ", part int, edge int, text string"), "fingerprints")
    firsts = walked.where("edge = 1").select("part", F.col("text").alias("next_text"), F.col("fingerprint").alias("next_print"))
    parts = sorted(r[0] for r in firsts.select("part").collect())  # numbers of the ranges, one each
    follow = dict(zip(parts, parts[1:] + parts[:1]))
    pairs = F.create_map(*[F.lit(x) for p in follow.items() for x in p]) if follow else F.create_map(F.lit(0), F.lit(0))
    lasts = walked.where("edge = 2").select("k", "text", "fingerprint", pairs[F.col("part")].alias("part"))
    ends = lasts.join(firsts, "part").select("k", "text", "fingerprint", "next_text", "next_print")

    def close(batches):
        for batch in batches:
            rows = [row((k, t, f), (None, nt, nf)) for k, t, f, nt, nf in zip(*(c.to_pylist() for c in batch.columns))]
            yield pa.RecordBatch.from_arrays(results(rows, batch.column(0).type), columns)

    done = walked.where("edge = 0").select(*columns).union(ends.mapInArrow(close, schema))
    return done.withColumnRenamed("k", "doc_id")
