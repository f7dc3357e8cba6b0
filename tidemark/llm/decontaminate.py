"""Benchmark decontamination by Wu-Manber multi-pattern search.

The test strings are the windows of the benchmark items, as bytes: words joined by single spaces, with
a space at either end. For the patterns of one length class the scan looks at a block of bytes at the
end of a window of the shortest pattern's length. A shift table says how far that window can move
without passing an occurrence; where the shift is 0, the suffix hash picks the few patterns whose
window ends with this block, a prefix hash thins them out, and direct comparison confirms.

The scan itself is vectorised: the text of a batch is cut into lanes, all lanes step at once, each by
its own shift. Documents are never shuffled. The benchmark goes to the tasks in blocks of a stated
size, so a benchmark of any size can be searched; each batch of documents meets every block.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import ASCII_LOWER, arrow_input, arrow_output, small_batches

WINDOW = 10
LANE = 2048
#: Lower-cases A-Z and turns every ASCII byte that is no digit or letter into a space.
_WORDS = bytes(ASCII_LOWER[b] if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text, in UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()


@dataclass
class Group:
    """Patterns of one length class with their tables."""

    length: int  # of the window: the shortest pattern
    block: int  # bytes per block
    bits: int
    shift: np.ndarray  # by block hash
    keys: np.ndarray  # sorted (suffix hash, prefix hash) of the patterns
    order: list[int]  # pattern of each key


@dataclass
class Index:
    patterns: list[bytes]
    items: list[list]  # item ids of each pattern
    groups: list[Group]


def _block_values(data: np.ndarray, ends: np.ndarray, block: int) -> np.ndarray:
    out = data[ends - 1].astype(np.uint64)
    for k in range(2, block + 1):
        out |= data[ends - k].astype(np.uint64) << np.uint64(8 * (k - 1))
    return out


def _hash(values: np.ndarray, bits: int) -> np.ndarray:
    return ((values * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.intp)


def build(items: list[tuple], window: int = WINDOW) -> Index:
    """Tables for (item id, text) rows. Items without words have no window; a null id marks words but names no item."""
    found: dict[bytes, dict] = {}
    for item, text in items:
        words = words_of(text)
        for k in range(max(1, len(words) - window + 1) if words else 0):
            found.setdefault(b" " + b" ".join(words[k:k + window]) + b" ", {})[item] = True
    patterns = sorted(found)
    groups = []
    sizes = sorted({len(p) for p in patterns})
    while sizes:  # classes whose longest pattern is under twice the shortest keep the shifts long
        low = sizes[0]
        own = [k for k, p in enumerate(patterns) if low <= len(p) < 2 * low]
        sizes = [s for s in sizes if s >= 2 * low]
        groups.append(_group(patterns, own, low))
    return Index(patterns, [list(found[p]) for p in patterns], groups)


def _group(patterns: list[bytes], own: list[int], length: int) -> Group:
    block = 4 if length >= 12 else min(3, length)
    starts = np.frombuffer(b"".join(patterns[k][:length] for k in own), np.uint8)
    bits = int(min(22, max(12, np.ceil(np.log2(8 * len(starts))))))
    shift = np.full(1 << bits, length - block + 1, np.int32)
    begin = np.arange(len(own)) * length
    for end in range(block, length + 1):  # the last blocks come last, so the smallest shift stays
        shift[_hash(_block_values(starts, begin + end, block), bits)] = length - end
    keys = _keys(starts, begin + length, length, block)
    order = np.argsort(keys, kind="stable")
    return Group(length, block, bits, shift, keys[order], [own[k] for k in order])


def _keys(data: np.ndarray, ends: np.ndarray, length: int, block: int) -> np.ndarray:
    """Suffix and prefix of the windows ending at ``ends`` in one number: up to 4 bytes each."""
    take = min(4, length)
    prefix = _block_values(data, ends - length + take, take)
    return (_block_values(data, ends, block) << np.uint64(32)) | prefix


def scan(index: Index, data: np.ndarray) -> list[tuple[int, int]]:
    """(offset, pattern) of all occurrences in the bytes."""
    out = []
    raw = data.tobytes()
    for group in index.groups:
        if len(data) < group.length:
            continue
        ends = np.arange(group.length, len(data) + 1, LANE)
        stops = np.minimum(ends + LANE, len(data) + 1)
        hits = []
        while len(ends):
            shift = group.shift[_hash(_block_values(data, ends, group.block), group.bits)]
            zero = shift == 0
            if zero.any():
                hits.append(ends[zero])
                shift = np.maximum(shift, 1)
            ends = ends + shift
            live = ends < stops
            if not live.all():
                ends, stops = ends[live], stops[live]
        if not hits:
            continue
        ends = np.concatenate(hits)
        keys = _keys(data, ends, group.length, group.block)
        low, high = np.searchsorted(group.keys, keys), np.searchsorted(group.keys, keys, side="right")
        for k in np.flatnonzero(low < high):
            at = int(ends[k]) - group.length
            for c in range(low[k], high[k]):
                pattern = index.patterns[group.order[c]]
                if raw.startswith(pattern, at):
                    out.append((at, group.order[c]))
    return out


def search(index_blocks, texts: list[str | None]):
    """Per text: number of words, covered words (a boolean array, or None without a hit) and item ids found."""
    lists = [words_of(t) for t in texts]
    joined = [b" " + b" ".join(w) + b" " for w in lists]
    data = np.frombuffer(b"\n".join(joined), np.uint8)
    begin = np.concatenate([[0], np.cumsum([len(j) + 1 for j in joined])])
    covered, items = [None] * len(texts), [set() for _ in texts]
    for index in index_blocks:
        spaces = {}
        for at, p in scan(index, data):
            doc = int(np.searchsorted(begin, at, side="right")) - 1
            if doc not in spaces:
                spaces[doc] = np.flatnonzero(data[begin[doc]:begin[doc + 1] - 1] == 32)
            if covered[doc] is None:
                covered[doc] = np.zeros(len(lists[doc]), bool)
            word = int(np.searchsorted(spaces[doc], at - begin[doc]))
            covered[doc][word:word + index.patterns[p].count(b" ") - 1] = True
            items[doc].update(index.items[p])
    return [len(w) for w in lists], covered, items


class Benchmark:
    """The item table as Spark broadcasts of at most about ``block_bytes`` of text each.

    The number of blocks follows from the measured size of the table; an item lies whole in one block.
    The driver holds one block at a time.
    """

    def __init__(self, items: DataFrame, item: str = "item_id", text: str = "text", window: int = WINDOW,
                 block_bytes: int = 16 << 20):
        spark = items.sparkSession
        rows = items.select(F.col(item).alias("i"), F.col(text).alias("t")).where("t IS NOT NULL")
        total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
        blocks = -(-total // block_bytes)
        part = F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) if blocks > 1 else None
        self.window = window
        self.blocks = [spark.sparkContext.broadcast(
            [(r["i"], r["t"]) for r in (rows if part is None else rows.where(part == b)).distinct().collect()])
            for b in range(blocks)]

    def indexes(self, cache: dict):
        """The blocks' tables; a single block is built once per task, several one after the other."""
        for k, block in enumerate(self.blocks):
            if k in cache:
                yield cache[k]
                continue
            index = build(block.value, self.window)
            if len(self.blocks) == 1:
                cache[k] = index
            yield index


def contamination(docs: DataFrame, benchmark: Benchmark, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
                  names: tuple[str, ...] = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans"),
                  spans: bool = False) -> DataFrame:
    """``keep`` columns, n_words, n_hit (words inside an occurring window), n_items, items_sha256 and contaminated.

    A window is 10 consecutive words of an item, or all words of a shorter one. items_sha256 is the digest
    of the found item ids, sorted as texts and joined by commas. Null and wordless texts have no words and
    no hit; items that repeat count once; a null item id marks words but is not listed. With ``spans`` the
    covered runs of words are added as (first, words). An empty benchmark hits nothing, an empty document
    table gives no rows; other columns are not read, ``names`` renames the added ones should they clash.
    """
    import pyarrow as pa

    small_batches(docs.sparkSession)
    taken, schema, place = arrow_input(docs, keep, text)
    schema += "p0 long, p1 long, p2 long, p3 string, p4 boolean" + ", p5 array<struct<first:int,words:int>>" * spans

    def look(batches):
        cache: dict = {}
        for batch in batches:
            n_words, covered, items = search(benchmark.indexes(cache), batch.column(place).to_pylist())
            named = [sorted(str(i) for i in found if i is not None) for found in items]
            n_hit = [0 if c is None else int(c.sum()) for c in covered]
            added = [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                     pa.array([len(x) for x in named], pa.int64()),
                     pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in named], pa.string()),
                     pa.array([h > 0 for h in n_hit], pa.bool_())]
            if spans:
                added.append(pa.array([_runs(c) for c in covered],
                                      pa.list_(pa.struct([("first", pa.int32()), ("words", pa.int32())]))))
            yield arrow_output(batch, len(keep), added)

    return taken.mapInArrow(look, schema).toDF(*keep, *names[:5 + spans])


def _runs(covered) -> list[dict]:
    if covered is None:
        return []
    edge = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
    return [{"first": int(a), "words": int(b - a)} for a, b in zip(edge[::2], edge[1::2])]
