"""Phrase collocations from a weighted de Bruijn graph of words.

Nodes are 4-grams, edges 5-grams, and a text is a walk. Only the longest grams are counted over the corpus: every
position gives one row, the 5-gram that starts there, or the shorter gram that the end of the piece leaves. Such a short
row is the piece-end correction: a gram of k words occurs as often as the flow out of it (all rows it is a
prefix of) says, those that end with it included. One sort by words therefore yields the counts of all lengths.

Before that, positions are cut where no candidate can lie: at words, then at word pairs, that are rarer than the
threshold. Every candidate and every part of one consists of frequent words and pairs, so the cuts are further piece
ends and change no count of theirs. What is frequent goes to the tasks as a bitmap of at most 16 MB; if it fills up,
fewer rows are cut away and none is lost.

Words travel as 64-bit codes of (language, word); the codes of all words are checked to differ, and drawn anew if
not. A gram is its list of codes, so counts are exact. Counting combines in each task before rows are
moved, and grams are dealt by their first three words, not by a word or a pair that may be in every third place.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import mix64, small_batches, text_buffers
from tidemark.sources.sinks import materialize, scratch

LONGEST = 5
UNKNOWN = "und"
WORDS = [f"w{i}" for i in range(1, LONGEST + 1)]
#: Punctuation and line ends become this byte, which no UTF-8 text has; A-Z are lower-cased.
_END = b"\xff"
_PIECES = bytes(_END[0] if c in b".,;:!?\n\x0b\x0c\r" else c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Codes held by a task before they are counted and given out; entries of its table of words.
BUFFER, CACHE = 1 << 20, 1 << 19
#: Bits of a bitmap of frequent words or pairs, at most.
MOST_BITS = 1 << 27


def words_of(text: bytes) -> list[bytes]:
    """The words of a text, with ``_END`` where a piece ends: pieces end at punctuation and line ends, words at blanks
    and tabs."""
    return text.translate(_PIECES).replace(_END, b" \xff ").split()


class Coder(dict):
    """Numbers of the words of one language in one task; ``codes`` has the code of each number. Number 0, of code 0,
    is that of piece ends and of words that are surely not in the bitmap ``wanted``."""

    def __init__(self, lang: str, seed: int, wanted: bytes = b""):
        name = lang.encode()
        self.prefix, self.wanted = seed.to_bytes(4) + len(name).to_bytes(4) + name, wanted
        self.start = zlib.crc32(name + b" ")
        self[_END], self.codes = 0, [0]

    def code(self, word: bytes) -> int:
        return int.from_bytes(hashlib.blake2b(self.prefix + word, digest_size=8).digest()) or 1

    def __missing__(self, word: bytes) -> int:
        at = zlib.crc32(word, self.start) & 8 * len(self.wanted) - 1
        number = 0
        if self.wanted[at >> 3] >> (at & 7) & 1:
            number = len(self.codes)
            self.codes.append(self.code(word))
        self[word] = number
        return number


def in_bitmap(bitmap: np.ndarray, codes: np.ndarray) -> np.ndarray:
    at = codes & np.uint64(8 * len(bitmap) - 1)
    return (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def bitmap_of(codes: DataFrame) -> np.ndarray:
    """A bitmap of a column of codes, 16 bits a code and ``MOST_BITS`` at most; it is put together by tasks."""
    page = 1 << 15
    with scratch(codes.toDF("code"), "phrase-frequent") as codes:  # counted and then read: made once
        bits = max(page, min(MOST_BITS, 1 << (16 * codes.count()).bit_length()))
        spot = F.col("code").bitwiseAND(F.lit(bits - 1))
        pages = (codes.select(F.shiftright(spot, 15).alias("page"), spot.bitwiseAND(F.lit(page - 1)).alias("bit"))
                 .groupBy("page").agg(F.bitmap_construct_agg("bit").alias("bits")))
        out = np.zeros(bits // 8, np.uint8)
        for row in pages.toLocalIterator():
            out[row["page"] * (page // 8):(row["page"] + 1) * (page // 8)] = np.frombuffer(row["bits"], np.uint8)
    return out


def pair_codes(codes: np.ndarray) -> np.ndarray:
    """A code for each word and the next one; 0 where either is 0."""
    both = (codes[:-1] != 0) & (codes[1:] != 0)
    return np.where(both, mix64(codes[:-1] * np.uint64(0x9E3779B97F4A7C15) + codes[1:]) | np.uint64(1), np.uint64(0))


def _texts(batches) -> Iterator[tuple[str, bytes]]:
    for batch in batches:
        data, at = text_buffers(batch.column(1))
        data = data.tobytes()
        for lang, begin, end in zip(batch.column(0).to_pylist(), at[:-1].tolist(), at[1:].tolist()):
            yield lang, data[begin:end]


def _coded(batches, seed: int, words: bytes) -> Iterator[np.ndarray]:
    """Codes of many texts in a row, 0 at piece ends and in place of unwanted words."""
    coders, done, held, size = {}, [], {}, 0

    def give():  # of each language what has been read so far
        for lang, parts in held.items():
            codes = np.array(coders[lang].codes, np.uint64)
            done.extend(codes[np.array(part)] for part in parts)
        held.clear()

    for lang, text in _texts(batches):
        coder = coders.get(lang)
        if coder is None or len(coder) >= CACHE:
            give()
            coder = coders[lang] = Coder(lang, seed, words)
        part = list(map(coder.__getitem__, words_of(text)))
        part.append(0)
        held.setdefault(lang, []).append(part)
        size += len(part)
        if size >= BUFFER:
            give()
            yield np.concatenate(done)
            done, size = [], 0
    give()
    if done:
        yield np.concatenate(done)


def _signed(x: np.ndarray):
    import pyarrow as pa

    return pa.array(np.ascontiguousarray(x).view(np.int64), pa.int64())


def count_words(docs: DataFrame, seed: int) -> DataFrame:
    """(lang, word, code, n) of all words. ``docs``: lang without nulls, text."""
    import pyarrow as pa

    def make(batches):
        counts = {}

        def rows():
            for lang, found in counts.items():
                words, code = list(found), Coder(lang, seed).code
                for k in range(0, len(words), 50_000):
                    part = words[k:k + 50_000]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([lang] * len(part), pa.string()), pa.array(part, pa.binary()).cast(pa.string()),
                        _signed(np.array([code(w) for w in part], np.uint64)),
                        pa.array([found[w] for w in part], pa.int64())], ["lang", "word", "code", "n"])

        for k, (lang, text) in enumerate(_texts(batches)):
            found = counts.setdefault(lang, Counter())
            found.update(words_of(text))
            found.pop(_END, None)
            if not k % 64 and sum(map(len, counts.values())) >= CACHE:
                yield from rows()
                counts.clear()
        yield from rows()

    return docs.mapInArrow(make, "lang string, word string, code long, n long") \
        .groupBy("lang", "word", "code").agg(F.sum("n").alias("n"))


def count_pairs(docs: DataFrame, seed: int, words) -> DataFrame:
    """(pair, n) of neighbouring words of the bitmap ``words``. Two pairs may share a code: n is an upper bound."""
    import pyarrow as pa

    def make(batches):
        for codes in _coded(batches, seed, words.value.tobytes()):
            pairs = pair_codes(codes)
            found, n = np.unique(pairs[pairs != 0], return_counts=True)
            for k in range(0, len(found), 100_000):
                yield pa.RecordBatch.from_arrays([_signed(found[k:k + 100_000]), pa.array(n[k:k + 100_000], pa.int64())],
                                                 ["pair", "n"])

    return docs.mapInArrow(make, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def longest_grams(codes: np.ndarray, linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of LONGEST codes, one row a position, and how often each occurs; zeros follow where the piece
    ends. ``linked[i]``: word i + 1 goes on after word i. Positions followed by nothing are left out."""
    n = len(codes)
    at = np.flatnonzero(linked)
    rows = np.zeros((LONGEST, len(at)), np.uint64)
    rows[0], open_ = codes[at], np.ones(len(at), bool)
    for k in range(1, LONGEST):
        step = at + k
        open_ &= linked[np.minimum(step - 1, n - 2)] & (step < n)
        rows[k] = np.where(open_, codes[np.minimum(step, n - 1)], np.uint64(0))
    mixed = np.zeros(len(at), np.uint64)
    for row in rows:
        mixed = mix64(mixed * np.uint64(0x9E3779B97F4A7C15) + row)
    order = np.argsort(mixed)
    rows = rows[:, order]
    new = np.ones(len(at), bool)  # rows that share the mixed value but not the words stay apart
    new[1:] = (rows[:, 1:] != rows[:, :-1]).any(axis=0)
    first = np.flatnonzero(new)
    return rows[:, first], np.diff(np.append(first, len(at)))


def gram_rows(docs: DataFrame, seed: int, words, pairs) -> DataFrame:
    """(w1, .., w5, n): the rows of all positions, combined in each task."""
    import pyarrow as pa

    def make(batches):
        for codes in _coded(batches, seed, words.value.tobytes()):
            found = pair_codes(codes)
            linked = (found != 0) & in_bitmap(pairs.value, found)
            rows, n = longest_grams(codes, linked)
            for k in range(0, len(n), 100_000):
                yield pa.RecordBatch.from_arrays([*[_signed(r[k:k + 100_000]) for r in rows], pa.array(n[k:k + 100_000], pa.int64())],
                                                 [*WORDS, "n"])

    return docs.mapInArrow(make, ", ".join(f"{w} long" for w in WORDS) + ", n long")


def _joined(batches, rows: int = 1 << 16) -> Iterator:
    """Batches put together to about so many rows; none is empty."""
    import pyarrow as pa

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += len(batch)
        if size >= rows:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held).combine_chunks()


def flows(rows: DataFrame, least: int) -> DataFrame:
    """(k, w1, .., w5, f): the grams of 3 to LONGEST words that occur ``least`` times, and of those of 2 words the
    sums of each task. One sort by words: a gram's count is the sum over the rows that begin with it."""
    import pyarrow as pa

    def make(batches):
        carried = {}  # by length: the gram that the last batch ended in, and its sum so far

        def give(k, grams, f):
            some = (f >= least) | (k == 2)
            padded = [grams[i][some] if i < k else np.zeros(int(some.sum()), np.int64) for i in range(LONGEST)]
            return pa.RecordBatch.from_arrays([pa.array(np.full(int(some.sum()), k), pa.int32()), *map(pa.array, padded),
                                               pa.array(f[some], pa.int64())], ["k", *WORDS, "f"])

        for batch in _joined(batches):
            table = [batch.column(i).to_numpy() for i in range(LONGEST + 1)]
            changed = np.zeros(len(table[0]), bool)
            for k in range(1, LONGEST + 1):
                changed[1:] |= table[k - 1][1:] != table[k - 1][:-1]
                if k == 1:
                    continue
                changed[0] = True
                first = np.flatnonzero(changed)
                grams = [table[i][first] for i in range(k)]
                f = np.add.reduceat(table[LONGEST], first)
                if k in carried:
                    gram, so_far = carried[k]
                    if gram == tuple(int(g[0]) for g in grams):
                        f[0] += so_far
                    elif gram[-1]:
                        yield give(k, [np.array([g]) for g in gram], np.array([so_far]))
                carried[k] = tuple(int(g[-1]) for g in grams), int(f[-1])
                whole = grams[k - 1][:-1] != 0
                yield give(k, [g[:-1][whole] for g in grams], f[:-1][whole])
        for k, (gram, so_far) in carried.items():
            if gram[-1]:
                yield give(k, [np.array([g]) for g in gram], np.array([so_far]))

    dealt = rows.repartition(*WORDS[:3]).sortWithinPartitions(*WORDS)
    return dealt.mapInArrow(make, "k int, " + ", ".join(f"{w} long" for w in WORDS) + ", f long")


class Graph:
    """The counts of a corpus: ``words`` (lang, word, code, n) of all words, ``totals`` (lang, n), and ``grams``
    (g, f): the frequent grams of 2 to LONGEST words as lists of codes."""

    def __init__(self, docs: DataFrame, lang: str = "lang", text: str = "text", least: int = 100):
        spark = docs.sparkSession
        small_batches(spark)
        self.least = least
        taken = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text"))
        seed = 0
        while True:
            self.words = materialize(count_words(taken, seed), "phrase-words")
            if self.words.groupBy("code").count().where("count > 1").isEmpty():
                break
            seed += 1
        self.totals = self.words.groupBy("lang").agg(F.sum("n").alias("n"))
        send = spark.sparkContext.broadcast
        spot = F.crc32(F.concat("lang", F.lit(" "), "word").cast("binary"))  # as Coder has it
        words = send(bitmap_of(self.words.where(F.col("n") >= least).select(spot.alias("spot"))))
        pairs = send(bitmap_of(count_pairs(taken, seed, words).where(F.col("n") >= least).select("pair")))
        found = materialize(flows(gram_rows(taken, seed, words, pairs), least), "phrase-flows")
        words.unpersist()
        pairs.unpersist()
        gram = F.slice(F.array(*WORDS), 1, F.col("k")).alias("g")
        two = found.where("k = 2").groupBy("w1", "w2").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
        self.grams = materialize(found.where("k > 2").select(gram, "f").union(two.select(F.array("w1", "w2").alias("g"), "f")),
                                 "phrase-grams")

    def parts(self) -> DataFrame:
        """(g, f) of all that a frequent gram can be cut into."""
        single = self.words.where(F.col("n") >= self.least).select(F.array("code").alias("g"), F.col("n").alias("f"))
        return self.grams.union(single)

    def folded(self) -> DataFrame:
        """Frequent grams whose whole flow goes along one longer gram: (g). They lie on that gram's path and say
        nothing of their own. A gram's flow is at least that of any gram around it, so it is enough to look one word
        to either side."""
        longer = self.grams.where(F.size("g") > 2)
        around = longer.select(F.slice("g", 1, F.size("g") - 1).alias("g"), "f") \
            .union(longer.select(F.slice("g", 2, F.size("g") - 1).alias("g"), "f"))
        return around.groupBy("g").agg(F.max("f").alias("most")).join(self.grams, "g").where("most >= f").select("g")

    def paths(self) -> DataFrame:
        """(g, f): the edges of the graph of frequent grams, unary paths compacted.

        Two edges go together at a node (4-gram) through which both pass with the node's whole flow. Each edge has one
        such follower at most, and no ring of them exists, as every piece enters and leaves. Pointers double every round.
        """
        edges = self.grams.where(F.size("g") == LONGEST).select("g", "f", F.slice("g", 2, LONGEST - 1).alias("end"))
        nodes = self.grams.where(F.size("g") == LONGEST - 1).select(F.col("g").alias("end"), F.col("f").alias("through"))
        leaving = edges.select(F.col("g").alias("next"), F.slice("g", 1, LONGEST - 1).alias("end"), F.col("f").alias("nf"))
        follow = edges.join(nodes, "end").where("f = through").join(leaving, "end").where("f = nf").select("g", "next")
        # each edge's leader so many steps back
        back = edges.select("g", "f").join(follow.select(F.col("next").alias("g"), F.col("g").alias("head")), "g", "left")
        now = materialize(back.select("g", "f", F.coalesce("head", "g").alias("head"),
                                      F.when(F.col("head").isNull(), 0).otherwise(1).cast("long").alias("at")), "phrase-paths")
        while True:
            ahead = now.select(F.col("g").alias("head"), F.col("head").alias("further"), F.col("at").alias("more"))
            step = materialize(now.join(ahead, "head").select("g", "f", F.col("further").alias("head"),
                                                              (F.col("at") + F.col("more")).alias("at"), "more"), "phrase-paths")
            now = step.drop("more")
            if step.where("more > 0").isEmpty():
                break
        last = F.array_sort(F.collect_list(F.struct("at", F.element_at("g", LONGEST).alias("w"))))
        return now.groupBy("head").agg(last.alias("rest"), F.max("f").alias("f")).select(
            F.concat(F.slice("head", 1, LONGEST - 1), F.col("rest.w")).alias("g"), "f")

    def spelled(self, grams: DataFrame) -> DataFrame:
        """``grams`` with lang and phrase in place of the codes ``g``."""
        others = [c for c in grams.columns if c != "g"]
        each = grams.select("g", F.posexplode("g").alias("at", "code"))
        named = each.join(self.words.where(F.col("n") >= self.least).select("lang", "word", "code"), "code")
        text = F.concat_ws(" ", F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]))
        names = named.groupBy("g").agg(F.first("lang").alias("lang"), text.alias("phrase"))
        return grams.join(names, "g").select("lang", "phrase", *others)


#: floor(1000 * a * n / (l * r)); products of 38 digits are exact.
SCORE = ("(cast(1000 * a as decimal(19,0)) * cast(n as decimal(18,0))) div "
         "(cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")


def top_per_group(rows: DataFrame, group: str, order: list, top: int, name: str, tie: str) -> DataFrame:
    """The first ``top`` rows of each group, numbered from 1; first in parts of a group, then over what they leave."""
    parts = Window.partitionBy(group, "__part").orderBy(*order)
    some = rows.withColumn("__part", F.pmod(F.xxhash64(tie), F.lit(4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))))
    some = some.withColumn("__at", F.row_number().over(parts)).where(F.col("__at") <= top).drop("__part", "__at")
    return some.withColumn(name, F.row_number().over(Window.partitionBy(group).orderBy(*order)).cast("long")) \
        .where(F.col(name) <= top)


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = 100, top: int = 2000,
                 graph: Graph | None = None) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best ``top`` phrases of 2 to 5 words of each language.

    a: how often the phrase occurs (``least`` times at least), l and r: its two parts at the cut with the lowest
    score (ties: the shortest first part), n: the words of the language, score: floor(1000 a n / (l r)). Phrases
    that a longer frequent phrase holds as often are left out. Order: score and a descending, phrase ascending by bytes.

    Null languages count as ``und``; null and empty texts hold nothing; rows that repeat count each time. Other columns
    are not read; a table without frequent phrases, or without rows, gives no rows.
    """
    graph = graph or Graph(docs, lang, text, least)
    parts = graph.parts()
    left = parts.select(F.col("g").alias("left"), F.col("f").alias("l"))
    right = parts.select(F.col("g").alias("right"), F.col("f").alias("r"))
    own = graph.grams.join(graph.folded(), "g", "left_anti").select("g", F.col("f").alias("a"))
    named = materialize(graph.spelled(own.withColumn("codes", F.col("g"))), "phrase-own")
    cuts = (named.join(graph.totals, "lang")
            .withColumn("cut", F.explode(F.sequence(F.lit(1), F.size("codes") - 1)))
            .withColumn("left", F.expr("slice(codes, 1, cut)")).withColumn("right", F.expr("slice(codes, cut + 1, 5)"))
            .join(left, "left").join(right, "right"))
    scored = cuts.withColumn("score", F.expr(SCORE))
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "a", "l", "r", "n")).alias("b"))
    rows = best.select("lang", "phrase", "b.a", "b.l", "b.r", "b.n", "b.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    return top_per_group(rows, "lang", order, top, "rank", "phrase") \
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
