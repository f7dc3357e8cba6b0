"""Reversible line dedup: exact reference counts of lines, with sharded cuckoo filters in front of them.

A ``LineIndex`` is a folder of tables. ``log`` holds a row (line digest, doc_id, +1 or -1) for every distinct
line of every document that came or went; the reference count of a line is the sum of its signs, so inserting and
deleting documents are appends, and a deletion undoes an insertion exactly. Lines whose count has reached the
threshold are kept in cuckoo filters, one per shard of the digest space. A cuckoo filter, unlike a Bloom filter,
can forget: a line that falls below the threshold is taken out again. While the filters are small (a checked
bound) they go to every task, which then moves only rows of lines that may be repeated; what they let through is
looked up in the exact counts, so a false hit costs time and never a line.

Counting combines before the shuffle, so a line held by a third of all documents is one row a task. Batches and
filter versions are folders of their own, and count once the index says so: a step that was interrupted is simply
written again.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.llm.common import arrow_input, arrow_output, maybe_in, small_batches, text_buffers
from tidemark.session import work_dir
from tidemark.sources.sinks import materialize, scratch

#: Filters of more bytes than this are not sent to the tasks: all rows then go to the exact counts.
MOST_FILTER_BYTES = 16 << 20
#: Lines that one filter is built for; more lines make more shards.
LINES_PER_SHARD = 100_000


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; a line has two possible buckets, each found from the other.

    A table that takes no more fingerprints gets another one of the same size behind it, so adding never fails.
    """

    SLOTS, KICKS = 4, 200

    def __init__(self, buckets: int, tables: list[array] | None = None):
        if buckets & (buckets - 1):
            raise ValueError("the number of buckets must be a power of two")
        self.buckets, self.tables = buckets, tables or [array("H", bytes(2 * self.SLOTS * buckets))]

    @classmethod
    def load(cls, buckets: int, stored: bytes) -> CuckooFilter:
        size = 2 * cls.SLOTS * buckets
        return cls(buckets, [array("H", stored[k:k + size]) for k in range(0, len(stored), size)])

    def dump(self) -> bytes:
        return b"".join(t.tobytes() for t in self.tables)

    def _place(self, line: bytes) -> tuple[int, int]:
        return int.from_bytes(line[4:8], "little") & (self.buckets - 1), int.from_bytes(line[8:10], "little") or 1

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ (mark * 0x5BD1E995 >> 7) & (self.buckets - 1)

    def _swap(self, table: array, bucket: int, old: int, new: int) -> bool:
        for k in range(bucket * self.SLOTS, (bucket + 1) * self.SLOTS):
            if table[k] == old:
                table[k] = new
                return True
        return False

    def add(self, line: bytes) -> None:
        bucket, mark = self._place(line)
        for table in self.tables:
            if self._swap(table, bucket, 0, mark) or self._swap(table, self._other(bucket, mark), 0, mark):
                return
        for turn in range(self.KICKS):  # push others out of the last table's buckets
            slot = bucket * self.SLOTS + (turn * 7 + mark) % self.SLOTS  # no dice: a lost task does the same again
            table[slot], mark = mark, table[slot]
            bucket = self._other(bucket, mark)
            if self._swap(table, bucket, 0, mark):
                return
        self.tables.append(array("H", bytes(2 * self.SLOTS * self.buckets)))
        self._swap(self.tables[-1], bucket, 0, mark)

    def remove(self, line: bytes) -> None:
        """Take out a line that was added."""
        bucket, mark = self._place(line)
        for table in self.tables:
            if self._swap(table, bucket, mark, 0) or self._swap(table, self._other(bucket, mark), mark, 0):
                return
        raise KeyError("the line is not in the filter")

    def __contains__(self, line: bytes) -> bool:
        bucket, mark = self._place(line)
        return any(mark in t[b * self.SLOTS:(b + 1) * self.SLOTS]
                   for t in self.tables for b in (bucket, self._other(bucket, mark)))


class FilterSet:
    """The filters of all shards side by side, asked for many lines at once."""

    def __init__(self, shards: int, buckets: int, stored: dict[int, bytes]):
        self.shards, self.buckets = shards, buckets
        size = 2 * CuckooFilter.SLOTS * buckets
        depth = max((len(s) // size for s in stored.values()), default=0)
        self.tables = np.zeros((depth, shards, buckets, CuckooFilter.SLOTS), np.uint16)
        for shard, s in stored.items():
            held = np.frombuffer(s, np.uint16).reshape(-1, buckets, CuckooFilter.SLOTS)
            self.tables[:len(held), shard] = held

    def may_hold(self, lines: np.ndarray) -> np.ndarray:
        """For digests (n, 16) of bytes: False where the line is surely in no filter."""
        if not len(lines) or not len(self.tables):
            return np.zeros(len(lines), bool)
        shard = shard_of(lines, self.shards)
        bucket = np.ascontiguousarray(lines[:, 4:8]).view("<u4")[:, 0].astype(np.int64) & (self.buckets - 1)
        mark = np.ascontiguousarray(lines[:, 8:10]).view("<u2")[:, 0].astype(np.int64)
        mark[mark == 0] = 1
        other = bucket ^ (mark * 0x5BD1E995 >> 7) & (self.buckets - 1)
        hit = np.zeros(len(lines), bool)
        for table in self.tables:
            for b in (bucket, other):
                hit |= (table[shard, b] == mark[:, None]).any(axis=1)
        return hit


def shard_of(lines: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each digest: its first four bytes, big-endian."""
    return np.ascontiguousarray(lines[:, :4]).view(">u4")[:, 0].astype(np.int64) & (shards - 1)


def line_key(line: bytes) -> bytes:
    """What makes two lines equal: no white space at the ends, A-Z lower-cased."""
    return line.strip().lower()


def digest(line: bytes, least_chars: int) -> bytes | None:
    """16 bytes of a line's key; None for a key of fewer code points."""
    key = line_key(line)
    if len(key) < least_chars or len(key) < 4 * least_chars and len(key.decode("utf-8", "replace")) < least_chars:
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


def digests(column) -> np.ndarray:
    """An Arrow column of 16-byte digests as an array (n, 16)."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 16)


class LineIndex:
    """Reference counts of the lines of a changing set of documents, kept in a folder.

    A document is all rows with its id; a null id is one document, below all others. Lines are cut at line feeds;
    keys shorter than ``least_chars`` code points are never counted. One writer at a time; a batch counts once its
    row of ``state`` is written, and a new object on the same ``path`` goes on from the last such row.
    """

    def __init__(self, spark: SparkSession, key_type: T.DataType, path: str | None = None, threshold: int = 3,
                 least_chars: int = 20):
        self.spark, self.path = spark, path or work_dir(spark, "line-index")
        self.threshold, self.least_chars = threshold, least_chars
        self.log_schema = T.StructType([T.StructField("line", T.BinaryType()), T.StructField("doc_id", key_type),
                                        T.StructField("sign", T.IntegerType())])
        self.version, self.shards, self.buckets = 0, 1, 64
        if path is not None and _exists(spark, f"{self.path}/state"):
            found = spark.read.schema(_STATE).parquet(f"{self.path}/state").orderBy(F.desc("version")).first()
            self.version, self.shards, self.buckets = found

    # -- the exact tables

    def log(self) -> DataFrame:
        """(line, doc_id, sign) of everything that came and went."""
        reader = self.spark.read.schema(self.log_schema)
        return reader.parquet(*[f"{self.path}/log/{v}" for v in range(1, self.version + 1)]) if self.version else \
            self.spark.createDataFrame([], self.log_schema)

    def counts(self) -> DataFrame:
        """(line, n): in how many documents each line is now."""
        return self.log().groupBy("line").agg(F.sum("sign").alias("n")).where("n > 0")

    def repeated(self) -> DataFrame:
        """The lines that have reached the threshold."""
        return self.counts().where(F.col("n") >= self.threshold)

    def holders(self) -> DataFrame:
        """(line, doc_id) of the repeated lines: who has them now."""
        rows, filters = self.log(), self.filters()
        if filters is not None:
            rows = _may_hold(rows, self.spark.sparkContext.broadcast(filters))
        rows = rows.join(self.repeated().select("line"), "line", "left_semi")
        return rows.groupBy("line", "doc_id").agg(F.sum("sign").alias("n")).where("n > 0").drop("n")

    # -- changes

    def insert(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> None:
        """Add documents. One that is there already is replaced."""
        if self.version:
            self.delete(docs.select(F.col(key).alias("doc_id")))
        found = _lines(docs, key, text, self.least_chars).distinct()
        self._append(found.withColumn("sign", F.lit(1)))

    def delete(self, ids: DataFrame) -> None:
        """Take documents out; ids that are not there are ignored. ``ids``: one column."""
        gone = ids.toDF("__gone").distinct()
        there = (self.log().join(gone, F.col("doc_id").eqNullSafe(F.col("__gone")), "left_semi")
                 .groupBy("line", "doc_id").agg(F.sum("sign").alias("n")).where("n > 0").drop("n"))
        self._append(there.withColumn("sign", F.lit(-1)))

    def _append(self, rows: DataFrame) -> None:
        rows.select("line", "doc_id", F.col("sign").cast("int").alias("sign")) \
            .write.mode("overwrite").parquet(f"{self.path}/log/{self.version + 1}")
        fresh = self.spark.read.schema(self.log_schema).parquet(f"{self.path}/log/{self.version + 1}")
        change = fresh.groupBy("line").agg(F.sum("sign").alias("change"))
        before = self.log()
        if self.version:  # only the touched lines' rows are moved
            with scratch(change, "line-change") as change:
                touched = change.select("line")
                known = maybe_in(before, "line", touched, "maybe").where("maybe").groupBy("line").agg(F.sum("sign").alias("old"))
                self._note(change.join(known, "line", "left").withColumn("old", F.coalesce("old", F.lit(0))))
        else:
            self._note(change.withColumn("old", F.lit(0)))

    def _note(self, moved: DataFrame) -> None:
        """Bring the filters up to the counts: ``moved`` has the touched lines with ``old`` and ``change``."""
        high = F.col("old") + F.col("change") >= self.threshold
        crossed = moved.where(high != (F.col("old") >= self.threshold)).select("line", high.alias("up"))
        with scratch(crossed, "line-crossed") as crossed:
            self.version += 1
            n = crossed.count()
            held = 0 if self.version == 1 else self._stored(self.version - 1).agg(F.sum("n")).first()[0] or 0
            shards = max(self.shards, 1 << max(0, (held + n - 1) // LINES_PER_SHARD).bit_length())
            if self.version == 1 or shards > self.shards:  # made anew from the exact counts, in more shards
                lines = crossed if self.version == 1 else self.repeated().select("line", F.lit(True).alias("up"))
                per_shard = min(LINES_PER_SHARD, max(64, held + n))
                self.shards, self.buckets = shards, 1 << (per_shard // 2 - 1).bit_length()
                old = self.spark.createDataFrame([], _FILTER)
            else:
                lines, old = crossed, self._stored(self.version - 1)
            _update(lines, old, self.shards, self.buckets).write.mode("overwrite") \
                .parquet(f"{self.path}/filters/{self.version}")
            self.spark.createDataFrame([(self.version, self.shards, self.buckets)], _STATE).coalesce(1) \
                .write.mode("append").parquet(f"{self.path}/state")

    # -- the filters

    def _stored(self, version: int) -> DataFrame:
        return self.spark.read.schema(_FILTER).parquet(f"{self.path}/filters/{version}")

    def filters(self) -> FilterSet | None:
        """All filters, or None if they are too large to send to the tasks."""
        if not self.version:
            return FilterSet(1, 64, {})
        stored = self._stored(self.version)
        deepest = stored.agg(F.max(F.length("slots"))).first()[0] or 0
        if deepest * self.shards > MOST_FILTER_BYTES:
            return None
        return FilterSet(self.shards, self.buckets, {r["shard"]: bytes(r["slots"]) for r in stored.collect()})

    # -- use

    def drops(self) -> DataFrame:
        """(doc_id, lines): the repeated lines that a document loses because one with a larger id holds them."""
        with scratch(self.holders(), "line-holders") as held:
            last = held.groupBy("line").agg(F.max("doc_id").alias("last"))
            lost = held.join(last, "line").where(~F.col("doc_id").eqNullSafe(F.col("last")))
            return materialize(lost.groupBy("doc_id").agg(F.collect_list("line").alias("lines")), "line-drops")

    def clean(self, docs: DataFrame, key: str = "doc_id", text: str = "text", keep_text: str | None = None,
              names: tuple[str, ...] = ("n_lines", "n_dropped", "kept_sha256")) -> DataFrame:
        """Per row of ``docs``, whose documents are in the index: the key, the number of lines, of dropped lines, and a
        digest of the text that stays; ``keep_text`` names a column for that text itself.

        A repeated line goes from every document but the one with the largest id. Of documents that lose nothing
        no text is moved between tasks. A null or empty text is one empty line. Repeated rows are each answered.
        """
        drops = self.drops()
        columns = [F.col(key).alias("k"), F.col(text).alias("t")]
        flagged = maybe_in(docs.select(*columns), "k", drops.select("doc_id"), "maybe")
        whole = flagged.where("NOT maybe").select("k", "t", F.lit(None).cast("array<binary>").alias("lines"))
        cut = flagged.where("maybe").join(drops, F.col("k").eqNullSafe(F.col("doc_id")), "left").select("k", "t", "lines")
        wanted = [*names, keep_text] if keep_text else names
        return _without(whole, self.least_chars, bool(keep_text)).union(_without(cut, self.least_chars, bool(keep_text))) \
            .toDF(key, *wanted)


_FILTER, _STATE = "shard int, n long, slots binary", "version int, shards int, buckets int"


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _lines(docs: DataFrame, key: str, text: str, least_chars: int) -> DataFrame:
    """(line, doc_id) for the distinct keys of each row."""
    import pyarrow as pa

    small_batches(docs.sparkSession)
    taken, kinds, place = arrow_input(docs, (key,), text)

    def make(batches):
        for batch in batches:
            data, at = text_buffers(batch.column(place))
            data, lines, rows = data.tobytes(), [], []
            for row, (begin, end) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
                found = {digest(x, least_chars) for x in data[begin:end].split(b"\n")} - {None}
                lines.extend(found)
                rows.extend([row] * len(found))
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.binary()), batch.column(0).take(pa.array(rows, pa.int64()))],
                                             ["line", "doc_id"])

    return taken.mapInArrow(make, f"line binary, doc_id {taken.schema['k0'].dataType.simpleString()}")


def _may_hold(rows: DataFrame, filters) -> DataFrame:
    """The rows whose ``line`` may be in the filters."""
    import pyarrow as pa

    def make(batches):
        for batch in batches:
            yield batch.filter(pa.array(filters.value.may_hold(digests(batch.column(0)))))

    return rows.mapInArrow(make, rows.schema)


def _update(lines: DataFrame, old: DataFrame, shards: int, buckets: int) -> DataFrame:
    """The filters after lines came (up) or went; a shard's lines are changes of one batch or at most its capacity."""
    import pyarrow as pa

    def change(came, had) -> Iterator:
        shard = (came.column("shard") if len(came) else had.column("shard"))[0].as_py()
        kept = CuckooFilter.load(buckets, had.column("slots")[0].as_py()) if len(had) else CuckooFilter(buckets)
        n = had.column("n")[0].as_py() if len(had) else 0
        changes = sorted(zip(came.column("up").to_pylist(), came.column("line").to_pylist())) if len(came) else []
        for up, line in changes:  # departures first
            (kept.add if up else kept.remove)(line)
            n += 1 if up else -1
        return pa.table({"shard": pa.array([shard], pa.int32()), "n": pa.array([n], pa.int64()),
                         "slots": pa.array([kept.dump()], pa.binary())})

    number = F.conv(F.hex(F.col("line").substr(1, 4)), 16, 10).cast("long")
    placed = lines.select("line", "up", (number % shards).cast("int").alias("shard"))
    return placed.groupBy("shard").cogroup(old.groupBy("shard")).applyInArrow(change, _FILTER)


def _without(rows: DataFrame, least_chars: int, with_text: bool) -> DataFrame:
    """Rows (k, t, lines) without the lines whose digests are listed."""
    import pyarrow as pa

    small_batches(rows.sparkSession)

    def make(batches):
        for batch in batches:
            data, at = text_buffers(batch.column(1))
            data, columns = data.tobytes(), [[], [], [], []]
            for begin, end, drop in zip(at[:-1].tolist(), at[1:].tolist(), batch.column(2).to_pylist()):
                lines = data[begin:end].split(b"\n")
                gone = set(drop or ())
                kept = [x for x in lines if digest(x, least_chars) not in gone] if gone else lines
                stays = b"\n".join(kept)
                for column, value in zip(columns, (len(lines), len(lines) - len(kept), hashlib.sha256(stays).hexdigest(), stays)):
                    column.append(value)
            added = [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())]
            if with_text:
                added.append(pa.array(columns[3], pa.binary()).cast(pa.string()))
            yield arrow_output(batch, 1, added)

    kind = rows.schema["k"].dataType.simpleString()
    return rows.mapInArrow(make, f"k0 {kind}, p0 long, p1 long, p2 string" + ", p3 string" * with_text)


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = 3, least_chars: int = 20,
                keep_text: str | None = None) -> DataFrame:
    """All of ``docs`` inserted into a new index and cleaned with it (see ``LineIndex.clean``). Other columns are not
    read; an empty table gives no rows."""
    index = LineIndex(docs.sparkSession, docs.schema[key].dataType, threshold=threshold, least_chars=least_chars)
    index.insert(docs, key, text)
    return index.clean(docs, key, text, keep_text)
