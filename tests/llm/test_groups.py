"""Near duplicates, slots, packing and the pipeline."""

import collections
import re
import uuid
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import near_dedup, packing, queries, slots
from tidemark.session import work_dir

WORDS = [f"w{k}" for k in range(5000)]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _shingles(text):
    words = re.findall("[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[k:k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def _components(rows):
    """Brute force over (doc_id, text) with distinct ids."""
    sets = {i: _shingles(t) for i, t in rows}
    where = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    common = collections.Counter((a, b) for ids in where.values() for k, b in enumerate(ids) for a in ids[:k])
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def _found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_near_duplicate_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert _found(queries.QUERIES["op10_near_dedup"](spark, sf)) == _components(rows)


def test_crowd_of_edited_copies_and_chains(spark):
    """Copies with few to many edits, a chain whose ends are unlike, a shared passage, and borderline pairs."""
    rng = np.random.default_rng(8)
    base, rows = list(rng.choice(WORDS, 120)), []
    for k in range(220):
        copy = list(base)
        for at in rng.choice(120, rng.integers(0, 9), replace=False):
            copy[at] = str(rng.choice(WORDS))
        rows.append((k, " ".join(copy)))
    chain = list(rng.choice(WORDS, 100))
    for k in range(300, 330):
        rows.append((k, " ".join(chain)))
        at = 7 * (k - 300) % 96
        chain[at:at + 3] = rng.choice(WORDS, 3)
    passage = " ".join(rng.choice(WORDS, 60))
    rows += [(400 + k, passage + " " + " ".join(rng.choice(WORDS, int(rng.integers(5, 60))))) for k in range(150)]
    for k in range(600, 660):  # 75 of 100 exactly at, just above and just below the bound
        shared = list(rng.choice(WORDS, 160))
        rows += [(2 * k, " ".join(shared)), (2 * k + 1, " ".join(shared[:k % 40 + 125]))]
    want = _components(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = _found(near_dedup.near_duplicates(df))
    wrong = [i for i in want if want[i] != got[i]]
    assert wrong == []
    assert sum(want[i][1] != i for i in want) > 200


def test_odd_rows(spark):
    long = " ".join(f"t{k}" for k in range(30000))
    rows = [(5, "A b c d e f", "x"), (3, "a B\tc\nd e f", "x"), (8, None, "x"), (9, "", None), (1, " \n ", "x"), (7, "one two", "x"),
            (6, "ONE  TWO", "x"), (6, "ONE  TWO", "x"), (None, "one two", "x"), (None, "alone here", "x"), (11, long, "x"),
            (12, long + " end", "x"), (4, "one two three", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(df).collect()), key=str)
    assert got == sorted([(5, 2, 3, False), (3, 2, 3, True), (8, 0, 8, True), (9, 0, 9, True), (1, 0, 1, True), (7, 1, 6, False),
                          (6, 1, 6, True), (6, 1, 6, True), (None, 1, 6, False), (None, 1, None, True), (11, 29996, 11, True),
                          (12, 29997, 11, False), (4, 1, 4, True)], key=str)
    left = near_dedup.keep_one(df)
    assert left.columns == df.columns
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted([3, 8, 9, 1, 6, None, 11, 4], key=str)
    assert near_dedup.near_duplicates(df.limit(0)).collect() == [] and near_dedup.keep_one(df.limit(0)).collect() == []


def test_star_hub_and_path_components(spark):
    edges = [(1, k) for k in range(2, 60)] + [(k, k + 1) for k in range(100, 160)] + [(160, 99), (70, 71), (5, 5)]
    rows = {r.cid: r.label for r in near_dedup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert rows == {**{k: 1 for k in range(1, 60)}, **{k: 99 for k in range(99, 161)}, 70: 70, 71: 70}


def test_one_of_near_copies_with_equal_and_null_ids(spark):
    words = " ".join(f"v{k}" for k in range(100))
    other = words.replace("v", "u")
    rows = [(1, words), (1, words + " end"), (1, "start " + words), (4, words.upper()), (None, words + " more"),
            (None, other), (None, other), (None, other + " end"), (None, "start " + other), (None, None), (7, "")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, kept string")
    left = near_dedup.keep_one(df).collect()
    assert sorted(((r.doc_id, "v1" in (r.text or ""), "u1" in (r.text or "")) for r in left), key=str) == sorted(
        [(1, True, False), (None, False, True), (None, False, False), (7, False, False)], key=str)
    marks = near_dedup.near_duplicates(df).collect()
    assert {r.component_id for r in marks if r.n_shingles} == {1, None}
    assert all(r.kept == (r.doc_id == r.component_id) for r in marks)  # the contract of the query: by id alone
    assert sum(r.kept for r in marks if r.doc_id == 1) == 3 and sum(r.stays for r in marks if r.doc_id == 1) == 1


def _stages_of(spark, work):
    """The result of ``work()`` and how many stages its jobs had, by Spark's own count."""
    context, group = spark.sparkContext, f"stages-{uuid.uuid4().hex}"
    context.setJobGroup(group, "counted")
    try:
        found = work()
    finally:
        for name in ("spark.jobGroup.id", "spark.job.description"):
            context.setLocalProperty(name, None)
    tracker = context.statusTracker()
    return found, sum(len(tracker.getJobInfo(j).stageIds) for j in tracker.getJobIdsForGroup(group))


def test_components_of_stars_take_few_stages(spark):
    """The driver keeps something of every stage it plans, and each round of the near duplicates calls this."""
    edges = spark.createDataFrame([(1, k) for k in range(2, 60)] * 2 + [(70, 71)], "a long, b long")
    rows, stages = _stages_of(spark, lambda: near_dedup.components(edges).collect())
    assert sorted((r.cid, r.label) for r in rows) == [(k, 1) for k in range(1, 60)] + [(70, 70), (71, 70)]
    assert stages <= 24


@pytest.mark.parametrize("links, nodes", [
    ([(2, 1), (3, 1), (5, 4)], []), ([(2, 1), (3, 2)], [2]), ([(3, 1), (3, 2)], [3]), ([(4, 3), (4, 1), (3, 1)], [3, 4]), ([], [])])
def test_no_star(spark, links, nodes):
    found = near_dedup._no_star(spark.createDataFrame(links, "a long, b long"))
    assert sorted(r.node for r in found.collect()) == nodes


@pytest.mark.parametrize("path", [[1, 5, 4, 3, 2], [2, 3, 4, 5, 1, 6], [3, 7, 1, 5, 4, 6, 2, 8]])
def test_components_of_one_path(spark, path):
    """After a step on the first, no node is both ends of links, but one has two smaller neighbours."""
    edges = spark.createDataFrame(list(zip(path, path[1:])), "a long, b long")
    assert sorted((r.cid, r.label) for r in near_dedup.components(edges).collect()) == [(x, 1) for x in sorted(path)]


def test_signature_does_not_depend_on_pieces():
    a, b = near_dedup._hash_parameters()
    shingles = np.random.default_rng(1).integers(0, 1 << 63, 9000, dtype=np.uint64)
    assert (near_dedup.signature(shingles, a, b) == near_dedup.signature(shingles, a, b, at_once=77)).all()


# slots


def _check_slots(rows):
    places = collections.defaultdict(list)
    for r in rows:
        places[r.shard].append(r.slot)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_slots_query(spark, sf):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.QUERIES["op4_virtual_slots"](spark, sf).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {
        k: (len(t.encode()) + 1, zlib.crc32(t.encode())) for k, t in docs.items()} and len(rows) == len(docs)
    load = collections.Counter()
    for r in rows:
        assert 0 <= r.shard < 8 and r.law == "bytes" and r.grown_shard is None
        load[r.shard] += r.size
    assert len(load) == 8 and max(load.values()) - min(load.values()) <= max(r.size for r in rows)
    _check_slots(rows)


def test_slots_of_piles_and_odd_rows(spark):
    rows = [(7, "same text", "s")] * 900 + [(None, None, "s")] * 300 + [(k, "t" * k, None) for k in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string")
    out = slots.shard(df, 8, slots=256).collect()
    assert len(out) == len(rows)
    _check_slots(out)
    load = collections.Counter()
    for r in out:
        load[r.shard] += r.size
    assert max(load.values()) < 1.1 * min(load.values())
    assert {r.size for r in out if r.doc_id is None} == {1} and {r.text_crc32 for r in out if r.doc_id is None} == {0}
    assert slots.shard(df.limit(0), 8).collect() == []


def test_map_versions_and_growth(spark, sf):
    path = work_dir(spark, "map-test")
    slots.shard(spark.read.parquet(f"{sf}/documents.parquet"), 4, slots=512, map_path=path).count()
    old, new = ({r.slot: (r.shard, r.bytes) for r in slots.read_map(spark, path, v).collect()} for v in (1, None))
    assert len(old) == len(new) == 512
    moved = [s for s in old if old[s][0] != new[s][0]]
    assert moved and all(new[s][0] == 4 for s in moved)
    load = collections.Counter()
    for shard, size in new.values():
        load[shard] += size
    assert max(load.values()) < 1.5 * sum(load.values()) / 5


# packing


def _encode():
    import public_tokenizers
    from tokenizers import Tokenizer
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own.encode_special_tokens = True
    return lambda texts: [e.ids for e in own.encode_batch(texts, add_special_tokens=False)]


def _check_pieces(rows, ids, limit=1024):
    """Every id lies in one piece, sequences have no gap, no overflow and little padding."""
    sequences, seen = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        own = ids[r.doc_id]
        assert r.doc_tokens == len(own) and r.length >= 1
        assert r.ids_crc32 == zlib.crc32(np.asarray(own[r.start:r.start + r.length], "<u4").tobytes())
        sequences[r.sequence_id].append((r.offset, r.length))
        seen[r.doc_id].append((r.start, r.length))
    for pieces in (*sequences.values(), *seen.values()):
        at = 0
        for start, length in sorted(pieces):
            assert start == at
            at += length
    assert {k: sum(n for _, n in v) for k, v in seen.items()} == {k: len(v) for k, v in ids.items()}
    sizes = [sum(n for _, n in p) for p in sequences.values()]
    assert max(sizes, default=0) <= limit
    padded = sum(limit - s for s in sizes if s & (s - 1))
    assert padded <= 0.02 * sum(sizes)


def test_packing_query(spark, sf):
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    ids = {k: [*x, 0] for (k, _), x in zip(docs, _encode()([t for _, t in docs]))}
    _check_pieces(queries.QUERIES["op7_vector_packing"](spark, sf).collect(), ids)


def test_packing_odd_texts(spark):
    texts = [None, "", " ", "a  b", "tab\there", "x \n y", "l1\nl2\n", " nb　sp", "it's 12,000!! ok...", "<|endoftext|> a", "word " * 9000,
             "\x00\x01", "q" * 5000, "é \U0001F600 z", "a.b c.d, e", "end.\nStart, go: 1. 2.", "a​b c", "﻿text x"]
    rows = [(k, t, "z") for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, length string")
    ids = {k: [*x, 0] for k, x in enumerate(_encode()([t or "" for t in texts]))}
    _check_pieces(packing.pack_documents(df).collect(), ids)
    assert packing.pack_documents(df.limit(0)).collect() == []
    twice = packing.pack_documents(spark.createDataFrame([(None, "a b c")] * 3, "doc_id long, text string")).collect()
    assert sum(r.length for r in twice) == 3 * len([*_encode()(["a b c"])[0], 0])


@pytest.mark.parametrize("cut", [True, False])
def test_all_limits_hold(cut):
    rng = np.random.default_rng(4)
    lengths = rng.integers(1, 400, 300).tolist()
    loss = [int(rng.integers(0, n + 1)) for n in lengths]
    packer = packing.Packer(512, 4, 200 if cut else 400, cut)
    out = packer.pack(lengths, loss)
    load = collections.defaultdict(lambda: [0, 0, 0.0])
    got = collections.Counter()
    for k, start, n, sequence, offset in out:
        assert offset == load[sequence][0]
        load[sequence][0] += n
        load[sequence][1] += 1
        load[sequence][2] += loss[k] * n / lengths[k]
        got[k] += n
    assert dict(got) == dict(enumerate(lengths))
    assert all(t <= 512 and s <= 4 and x <= (200 if cut else 400) + 1e-6 for t, s, x in load.values())
    assert packing.Packer().pack([], []) == []


# pipeline


def test_pipeline_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumns({"score": F.lit(1), "_at": F.lit("x"), "kept": F.lit(None).cast("string")})
    extra = spark.createDataFrame([(9001, None, "en", "s", 0, 1, "x", None), (9002, "  12 !", None, "s", 0, 1, "x", None),
                                   (None, "an unlabelled new text without an id", None, "s", 0, 1, "x", None)], docs.schema)
    docs = docs.union(extra)
    start = {r.doc_id: r.text for r in docs.collect()}
    sizes = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {(r.doc_id, r.text) for r in docs.collect()}
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns
        after = {(r.doc_id, r.text) for r in out.collect()}
        assert after <= before
        if name == "language":
            assert {i for i, _ in before - after} >= {9001, 9002}
        if name == "near duplicates":
            known = [(i, t) for i, t in before if i is not None]
            want = _components(known)
            assert {i for i, _ in after if i is not None} == {i for i, (_, c) in want.items() if i == c}
        docs = spark.createDataFrame(out.collect(), out.schema)
        sizes.append(len(after))
    kept = {r.doc_id: r.text for r in docs.collect()}
    pieces = corpus_pipeline.pack(spark, docs, sf).collect()
    assert {r.doc_id for r in pieces} == set(kept) and None in kept
    assert 0.5 * len(start) < sizes[-1] < len(start)


def test_pipeline_of_empty_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        assert out.collect() == []
