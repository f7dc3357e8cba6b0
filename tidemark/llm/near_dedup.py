"""Near duplicates by MinHash with tensored banding, links confirmed on full shingle sets.

Plain banding with L tables of 6 values needs 6 L minhashes. Here two small collections of SIDE triples
are drawn, ``u_1..u_n`` and ``v_1..v_n``; table (i, j) has the key ``(u_i, v_j)``. So n * n = 400 tables
come from 2 * 3 * n = 120 minhashes. Two texts meet in some table if some u triple and some v triple
agree: at a similarity of 0.75 they miss each other with a probability of about 3.5e-5, at 0.8 of 1.2e-6.

A table key is formed in two steps: classes of texts are grouped by ``u_i`` first, and only groups of
two or more go on to ``v_j``. Candidates then come in rounds: in a few star rounds every member of a
group is compared with one centre, links are joined into components, and groups that lie in one
component are done. What is left is compared pair by pair, but only pairs of different components
that share a full key (i, j) and pass exact bounds on their overlap. No pair inside a component is made.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import ASCII_LOWER, WordHasher, maybe_in, mix64, short_plan_texts, small_batches, text_buffers
from tidemark.sources.sinks import materialize, scratch

SHINGLE = 5
SIDE, DEEP = 20, 3
HASHES = 2 * SIDE * DEEP
SEPARATORS = b" \t\n\x0b\x0c\r"
SEED = 20251


def _hash_parameters() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return (rng.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
            rng.integers(0, 1 << 63, HASHES, dtype=np.uint64))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, hasher: WordHasher, width: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text; A-Z are lower-cased, words end at white space."""
    lower = np.frombuffer(ASCII_LOWER, np.uint8)
    n = len(offsets) - 1
    spaced = np.full(len(data) + n, 32, np.uint8)
    spaced[np.arange(len(data)) + np.repeat(np.arange(n), np.diff(offsets))] = lower[data]
    begin = offsets + np.arange(n + 1)
    starts, ends = hasher.words(spaced)
    words = hasher.hash(spaced, starts, ends)[0]
    bounds = np.searchsorted(starts, begin)
    factor = np.uint64(0xD1342543DE82EF95)
    rolled = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for k in range(width):
        rolled = rolled * factor + words[k:len(words) - width + 1 + k] if len(rolled) else rolled
    rolled = mix64(rolled)
    out = []
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a >= width:
            out.append(np.unique(rolled[a:b - width + 1]))
        elif b > a:
            whole = int(b - a)
            for w in words[a:b]:
                whole = (whole * int(factor) + int(w)) % (1 << 64)
            out.append(mix64(np.array([whole], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray, at_once: int = 4096) -> np.ndarray:
    """HASHES minimum values of a shingle set, 32 bits each."""
    low = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(shingles), at_once):
        part = shingles[None, k:k + at_once] * a[:, None]
        part += b[:, None]
        np.minimum(low, part.min(axis=1), out=low)
    return (low >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _text_key(text: str) -> Column:
    return F.xxhash64(F.lit(17), F.coalesce(F.col(text), F.lit("")))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, text_key (a hash of the text), n_shingles, digest (16 bytes of the shingle set) and
    sig (the minhashes; null for an empty set)."""
    import pyarrow as pa

    small_batches(docs.sparkSession)
    taken = docs.select(F.col(key).alias("doc_id"), _text_key(text).alias("text_key"), F.col(text).alias("text"))
    kind = taken.schema["doc_id"].dataType.simpleString()

    def make(batches):
        hasher, (a, b) = WordHasher(SEPARATORS), _hash_parameters()
        for batch in batches:
            sets = shingle_sets(*text_buffers(batch.column(2)), hasher)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                pa.array([signature(s, a, b) if len(s) else None for s in sets], pa.list_(pa.int32()))],
                ["doc_id", "text_key", "n_shingles", "digest", "sig"])

    return taken.mapInArrow(make, f"doc_id {kind}, text_key long, n_shingles long, digest binary, sig array<int>")


def packed(rows: DataFrame) -> DataFrame:
    """``rows`` with the text column compressed: texts travel between tasks in this form."""
    import pyarrow as pa

    at = rows.columns.index("text")

    def make(batches):
        for batch in batches:
            data, offsets = text_buffers(batch.column(at))
            small = [zlib.compress(data[i:j], 1) for i, j in zip(offsets[:-1], offsets[1:])]
            yield batch.set_column(at, "text", pa.array(small, pa.binary()))

    kinds = [f"`{f.name}` {'binary' if f.name == 'text' else f.dataType.simpleString()}" for f in rows.schema]
    return rows.mapInArrow(make, ", ".join(kinds))


def packed_sets(column, hasher: WordHasher) -> list[np.ndarray]:
    """Shingle sets of an Arrow column of packed texts; equal texts of the column are worked out once."""
    coded = column.dictionary_encode()
    texts = [zlib.decompress(t) for t in coded.dictionary.to_pylist()]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    sets = shingle_sets(np.frombuffer(b"".join(texts), np.uint8), offsets, hasher)
    return [sets[i] for i in coded.indices.to_pylist()]


def full_sets(texts: DataFrame) -> DataFrame:
    """(cid, shingles) for rows (cid, packed text)."""
    import pyarrow as pa

    def make(batches):
        hasher = WordHasher(SEPARATORS)
        for batch in batches:
            sets = packed_sets(batch.column(1), hasher)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["cid", "shingles"])

    return texts.select("cid", "text").mapInArrow(make, "cid long, shingles array<long>")


def _triples(side: int) -> Column:
    """Keys of one collection: a hash of (position, three minhashes) for each of its SIDE triples."""
    first = side * SIDE * DEEP
    return F.array(*[F.xxhash64(F.lit(side * SIDE + i), *[F.col("sig")[first + i * DEEP + k] for k in range(DEEP)])
                     for i in range(SIDE)])


def _no_star(links: DataFrame) -> DataFrame:
    """Nodes of distinct links (a, its centre b) that have two centres, or one and are a centre themselves.

    One exchange of partial sums finds both: the driver plans and runs this after every step of every round.
    """
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("centres"), F.lit(0).alias("centre")).union(
        links.select(F.col("b").alias("node"), F.lit(0).alias("centres"), F.lit(1).alias("centre")))
    return (ends.groupBy("node").agg(F.sum("centres").alias("centres"), F.max("centre").alias("centre"))
            .where("centres > 0 AND centres + centre > 1"))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(cid, label) for all ends of ``edges`` (a, b): label is the smallest id reachable.

    Alternating steps that hook every neighbour to the smallest one; each step is written to the shared
    folder. Minima are aggregated before rows meet, so a hub's neighbours need not share a task. Done when all
    links are stars (``_no_star``). Links may repeat; they are made distinct in each step.
    """
    now = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b"), name)
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = materialize(large, name)
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low).distinct())
        now = materialize(small, name)
        if _no_star(now).isEmpty():
            return now.select(F.col("a").alias("cid"), F.col("b").alias("label")).union(
                now.select(F.col("b").alias("cid"), F.col("b").alias("label")).distinct())


def _confirm(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose whole sets satisfy 100 * |intersection| >= percent * |union|.

    The packed texts are moved, and their sets made where they meet: a set takes several times the bytes.
    """
    import pyarrow as pa

    def make(batches):
        hasher = WordHasher(SEPARATORS)
        for batch in batches:
            links = []
            for x, y in zip(packed_sets(batch.column(2), hasher), packed_sets(batch.column(3), hasher)):
                common = len(np.intersect1d(x, y, assume_unique=True))
                links.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select([0, 1]).filter(pa.array(links, pa.bool_()))

    return (pairs.join(texts.select(F.col("cid").alias("a"), F.col("text").alias("ta")), "a")
            .join(texts.select(F.col("cid").alias("b"), F.col("text").alias("tb")), "b")
            .select("a", "b", "ta", "tb").mapInArrow(make, "a long, b long"))


def _plausible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs that share a table key and may reach the similarity.

    Sizes must allow it (exact), some u and some v triple must agree (the tables), and the estimate from
    all minhashes may not lie five standard deviations or more under the threshold.
    """
    p = percent / 100
    least = HASHES * p - 5 * (HASHES * p * (1 - p)) ** 0.5
    side = classes.select("cid", "n_shingles", "sig")
    same = F.zip_with("sa", "sb", lambda x, y: F.when(x == y, 1).otherwise(0))

    def agrees(offset):
        return F.exists(F.sequence(F.lit(0), F.lit(SIDE - 1)), lambda i: (
            F.get("same", offset + i * DEEP) + F.get("same", offset + i * DEEP + 1)
            + F.get("same", offset + i * DEEP + 2)) == DEEP)

    return (pairs.join(side.select(F.col("cid").alias("a"), F.col("n_shingles").alias("na"), F.col("sig").alias("sa")), "a")
            .join(side.select(F.col("cid").alias("b"), F.col("n_shingles").alias("nb"), F.col("sig").alias("sb")), "b")
            .where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
            .withColumn("same", same)
            .where((F.aggregate("same", F.lit(0), lambda x, y: x + y) >= least)
                   & agrees(0) & agrees(SIDE * DEEP)).select("a", "b"))


def _join_up(labels: DataFrame | None, fresh: DataFrame) -> DataFrame:
    """Labels after more links; the labels so far stand for the earlier ones."""
    known = [] if labels is None else [labels.select(F.col("cid").alias("a"), F.col("label").alias("b"))]
    for more in known:
        fresh = fresh.union(more)
    return components(fresh)


def _unfinished(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members (u, cid, label) of the groups that hold two components or more."""
    labelled = materialize(members.join(labels, "cid", "left")
                           .select("u", "cid", F.coalesce("label", "cid").alias("label")), "near-labelled")
    mixed = labelled.groupBy("u").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    return materialize(labelled.join(mixed.select("u"), "u", "left_semi"), "near-open")


def _star(members: DataFrame, centres: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) of each member and its group's centre (u, c, lc), where their labels differ."""
    return (members.join(centres, "u").where("label <> lc")
            .select(F.least("cid", "c").alias("a"), F.greatest("cid", "c").alias("b")).distinct())


def _share_whole_key(left: DataFrame, side: DataFrame) -> DataFrame:
    """The rows (u, cid, label) of members that share a whole table key (u_i, v_j) with a member of another label."""
    wide = (left.join(side.select("cid", F.explode(_triples(1)).alias("v")), "cid")
            .select(F.xxhash64("u", "v").alias("t"), "cid", "label"))
    mixed = wide.groupBy("t").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    met = wide.select("t", "cid").join(mixed.select("t"), "t", "left_semi").select("cid").distinct()
    return materialize(left.join(met, "cid", "left_semi").select("u", "cid", "label"), "near-open")


def _rare_first(sets: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """(cid, size, common, prefix) of the sets: how many shingles of a set occur in another one as well, and
    the rarest of those, ``prefix`` (n, s), so many that two sets of the wanted similarity share one of them.

    Shingles of one set only would come first in the prefix but lead to no other set: they are counted
    and left out. So are sets with too few common shingles for any link (overlap >= percent * larger set).
    """
    each = sets.select("cid", F.explode("shingles").alias("s"))
    often = each.groupBy("s").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rare = (each.join(often, "s").groupBy("cid")
            .agg(F.array_sort(F.collect_list(F.struct("n", "s"))).alias("r"), F.count(F.lit(1)).alias("common"))
            .join(sizes.select("cid", F.col("n_shingles").alias("size")), "cid")
            .where(100 * F.col("common") >= percent * F.col("size")))
    length = F.col("common") - F.ceil(F.col("size") * percent / 100) + 1
    return rare.select("cid", "size", "common", F.slice("r", 1, length.cast("int")).alias("prefix"))


def find_links(classes: DataFrame, texts_of, percent: int = 75, star_rounds: int = 2) -> DataFrame | None:
    """Labels (cid, label) of the classes that have a link; None without a candidate.

    ``texts_of(ids)`` gives (cid, packed text) for a table of distinct class ids. The rounds:

    1. ``star_rounds`` times, an arbitrary member of each group is its centre.
    2. Of the groups that still hold several components, those members go on that share a whole key
       (u_i, v_j) with another component. Count in how many of these texts each shingle occurs. Texts with
       too few shingles in common with any other are done.
    3. The member with the largest share of common shingles is the centre: in a crowd of edited copies it
       is the copy edited least, and nearly all that have links have one to it.
    4. Every pair of different components that shares one of its rarest shingles, within exact bounds.

    Candidates of every round must also share a table key (``_plausible``).
    """
    tables = classes.select("cid", F.explode(_triples(0)).alias("u"))
    shared = tables.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("u")
    members = materialize(tables.join(shared, "u", "left_semi"), "near-members")
    ids = materialize(members.select("cid").distinct(), "near-ids")
    if ids.isEmpty():
        return None
    few = maybe_in(classes.select("cid", "n_shingles", "sig"), "cid", ids, "maybe").where("maybe").drop("maybe")
    side = materialize(few.join(ids, "cid", "left_semi"), "near-side")

    def confirmed(pairs):  # only the texts of plausible pairs are moved
        pairs = materialize(_plausible(pairs, side, percent), "near-pairs")
        ends = pairs.select(F.col("a").alias("cid")).union(pairs.select(F.col("b").alias("cid"))).distinct()
        with scratch(texts_of(ends), "near-texts") as texts:
            return materialize(_confirm(pairs, texts, percent), "near-links")

    labels, left = None, members.withColumn("label", F.col("cid"))
    for turn in range(star_rounds):
        mask = F.lit(turn * 0x5851F42D4C957F2D & (1 << 63) - 1)
        centres = left.groupBy("u").agg(F.min(F.col("cid").bitwiseXOR(mask)).bitwiseXOR(mask).alias("c"))
        centres = centres.join(left.select("u", F.col("cid").alias("c"), F.col("label").alias("lc")), ["u", "c"])
        fresh = confirmed(_star(left, centres))
        if not fresh.isEmpty():
            labels = _join_up(labels, fresh)
        if labels is not None:
            left = _unfinished(left.select("u", "cid"), labels)
        if left.isEmpty():
            return labels
    left = _share_whole_key(left, side)
    if left.isEmpty():
        return labels
    with scratch(texts_of(left.select("cid").distinct()), "near-texts") as texts:
        rare = materialize(_rare_first(full_sets(texts), side, percent), "near-rare")
    best = left.join(rare.select("cid", "size", "common"), "cid").groupBy("u").agg(F.min(F.struct(
        (1 - F.col("common") / F.col("size")).alias("share"), "cid", "label")).alias("best"))
    fresh = confirmed(_star(left.join(rare.select("cid"), "cid"),
                            best.select("u", F.col("best.cid").alias("c"), F.col("best.label").alias("lc"))))
    if not fresh.isEmpty():
        labels = _join_up(labels, fresh)
    if labels is not None:
        left = _unfinished(left.select("u", "cid"), labels)
    fresh = confirmed(_remaining_pairs(left, rare, percent))
    return labels if fresh.isEmpty() else _join_up(labels, fresh)


def _remaining_pairs(left: DataFrame, rare: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) of different labels that may reach the similarity.

    They share one of their rarest shingles, their sizes allow it, and so does the number of shingles that
    follow the shared one in both (all exact bounds). For each shingle the members of its most frequent
    label meet only those of other labels, so the copies of one component never meet each other.
    """
    rows = materialize(left.select("cid", "label").distinct().join(rare, "cid").select(
        "cid", "label", "size", "common", F.posexplode("prefix").alias("at", "e"))
        .select("cid", "label", F.col("e.s").alias("s"), "size", (F.col("common") - F.col("at")).alias("rest")), "near-prefix")
    main = (rows.groupBy("s", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("s")
            .agg(F.max(F.struct("n", "label")).alias("top"), F.min("label").alias("low"), F.max("label").alias("high"))
            .where("low < high").select("s", F.col("top.label").alias("main")))
    rows = materialize(rows.join(main, "s"), "near-prefix")
    x, y = rows.where("label <> main").alias("x"), rows.alias("y")
    return (x.join(y, (F.col("x.s") == F.col("y.s")) & (F.col("x.label") != F.col("y.label"))
                   & ((F.col("y.label") == F.col("y.main")) | (F.col("x.cid") < F.col("y.cid")))
                   & (100 * F.least("x.size", "y.size") >= percent * F.greatest("x.size", "y.size"))
                   & ((100 + percent) * F.least("x.rest", "y.rest") >= percent * (F.col("x.size") + F.col("y.size"))))
            .select(F.least("x.cid", "y.cid").alias("a"), F.greatest("x.cid", "y.cid").alias("b")).distinct())


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 75,
                    names: tuple[str, ...] = ("doc_id", "n_shingles", "component_id", "kept", "text_key", "stays")) -> DataFrame:
    """Every row with the number of its shingles, its component and whether it is the one that stays.

    Shingles are 5 words (A-Z lower-cased, separated by white space); a shorter text is one shingle, a null
    or wordless text has none and is linked with nothing. Texts with equal sets form one class; classes are
    linked where 100 * intersection >= ``percent`` * union. component_id is the smallest key reachable; rows
    of a null key join a component but do not name it, and a component of null keys only has a null id. kept: the
    row's key is the component's, so near copies of one key are all kept. stays: the row has the component's smallest
    (key, text_key), null keys last, so of each component one row stays; texts without shingles are kept and stay.
    Repeated rows (same key and text) are each reported alike. An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    with scratch(fingerprints(docs, key, text), "near-prints") as signed:
        prints = materialize(signed.drop("sig"), "near-rows")
        grouped = signed.where("n_shingles > 0").groupBy("digest").agg(
            F.min("doc_id").alias("rep"), F.min_by("text_key", F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("text_key"),
            F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"))
        classes = materialize(grouped, "near-classes")
    seed = 0
    while True:  # 64-bit class ids: take another seed should two sets share one
        cid = F.xxhash64(F.lit(seed), "digest")
        if classes.groupBy(cid).count().where("count > 1").isEmpty():
            break
        seed += 1
    classes = classes.withColumn("cid", cid)
    row = F.xxhash64("doc_id", "text_key").alias("row")  # not the text alone: its copies are not wanted
    source = docs.select(F.col(key).alias("doc_id"), _text_key(text).alias("text_key"), F.col(text).alias("text"))
    source = source.select("*", row)

    def texts_of(ids):
        wanted = materialize(classes.join(ids, "cid", "left_semi")
                             .select("cid", F.col("rep").alias("doc_id"), "text_key"), "near-wanted")
        near = packed(maybe_in(source, "row", wanted.select(row), "maybe").where("maybe").drop("maybe", "row"))
        same = near["doc_id"].eqNullSafe(wanted["doc_id"]) & (near["text_key"] == wanted["text_key"])
        return near.join(wanted, same).groupBy("cid").agg(F.first("text").alias("text"))  # rows may repeat

    with short_plan_texts(spark):
        labels = find_links(classes, texts_of, percent)
    named = classes.select("cid", "rep", "text_key")
    named = named.withColumn("label", F.col("cid")) if labels is None else \
        named.join(labels, "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    low = named.groupBy("label").agg(F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", "text_key")).alias("low"))
    of_class = named.join(low, "label").select(F.col("cid"), F.col("low.rep").alias("component"),
                                               F.col("low.text_key").alias("first_text"))
    rows = prints.select("doc_id", "text_key", "n_shingles", F.when(F.col("n_shingles") > 0, cid).alias("cid"))
    component = F.when(F.col("cid").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    kept = F.col("doc_id").eqNullSafe(component)
    stays = F.col("cid").isNull() | kept & F.col("text_key").eqNullSafe(F.col("first_text"))
    return rows.join(of_class, "cid", "left").select(
        F.col("doc_id").alias(names[0]), F.col("n_shingles").alias(names[1]), component.alias(names[2]),
        kept.alias(names[3]), F.col("text_key").alias(names[4]), stays.alias(names[5]))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 75) -> DataFrame:
    """The rows of ``docs`` without near duplicates: one document of each component stays, and one of rows that
    repeat key and text. Columns are those of ``docs``; only rows that may go are moved between tasks."""
    with short_plan_texts(docs.sparkSession):
        marks = materialize(near_duplicates(docs, key, text, percent), "near-marks")
    gone = marks.where("NOT stays").select("doc_id", "text_key").distinct()
    repeated = marks.where("stays").groupBy("doc_id", "text_key").count().where("count > 1").select("doc_id", "text_key")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    tagged = docs.withColumns({"_tm_key": F.col(key), "_tm_text": _text_key(text)})
    flagged = maybe_in(tagged, "_tm_text", gone.union(repeated).select("text_key"), "_tm_maybe")
    doubtful = flagged.where("_tm_maybe")
    same = F.col("_tm_key").eqNullSafe(F.col("doc_id_gone")) & (F.col("_tm_text") == F.col("text_key_gone"))
    left = doubtful.join(gone.toDF("doc_id_gone", "text_key_gone"), same, "left_anti")
    if not repeated.isEmpty():
        left = left.dropDuplicates(["_tm_key", "_tm_text"])
    return flagged.where("NOT _tm_maybe").select(*columns).union(left.select(*columns))
