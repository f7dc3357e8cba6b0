"""Line dedup and periodic runs against plain versions."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tests.conftest import SMALL
from tidemark.llm import line_dedup as ld, periodic_runs as pr
from tidemark.llm.queries import QUERIES

SCHEMA = "doc_id long, text string"


def sha(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()


# -- op13

def plain_runs(w):
    """Every diagonal walked from end to end; of equal stretches the smallest period counts."""
    n, out = len(w), {}
    for q in range(1, n):
        i = q
        while i < n:
            j = i
            while j < n and w[j] == w[j - q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                out.setdefault((i - q, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, m, q) for (s, m), q in out.items()), key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text, planted=True):
    words = (text or "").encode().split()
    n = len(words)
    if planted:
        h = zlib.crc32(str("" if doc_id is None else doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-1e9 * r[1] / r[2], r[0], r[2]), default=(None,) * 3)
    return (doc_id, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2],
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()),
            sha(b" ".join(x for i, x in enumerate(words) if i not in gone)))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(1, 9), st.integers(1, 40)), max_size=8))
def test_runs_equal_plain_ones(parts):
    words = []
    for fresh, period, length in parts:
        words += [fresh] * (fresh + 1)
        words += (words[-period:] * length)[:length]
    assert pr.find_runs(np.array(words, np.int64)) == plain_runs(words)


def test_binary_words_of_every_shape():
    for n in range(12):
        for bits in range(1 << n):
            words = [bits >> k & 1 for k in range(n)]
            assert pr.find_runs(np.array(words, np.int64)) == plain_runs(words)


def test_long_periodic_texts_take_no_quadratic_time():
    n = 300_000
    assert pr.find_runs(np.zeros(n, np.int64)) == [(0, n, 1)]
    assert pr.find_runs(np.arange(n) % 70_000) == [(0, n, 70_000)]
    rng = random.Random(1)
    words = np.array([rng.randrange(3) for _ in range(2000)])
    assert pr.find_runs(words) == plain_runs(words.tolist())


def test_ties_go_to_the_earliest_run_and_ratios_are_exact():
    assert pr.strongest([(0, 8, 2), (3, 12, 3), (20, 13, 3)]) == (20, 13, 3)
    assert pr.strongest([(0, 8, 2), (3, 12, 3)]) == (0, 8, 2)
    assert pr.strongest([]) is None


def test_runs_of_hard_rows(spark):
    texts = [None, "", "  \n\t ", "a " * 6, "a " * 5, "x y " * 4, "x y " * 3 + "x", "  " * 7, "A a " * 4,
             "one two three " * 5 + "end", "b " * 1_500, "a a a a a a b a a a a a a b " * 4]
    rows = [(i, t) for i, t in enumerate(texts)] * 2 + [(None, "z " * 9), (7, "other text here")]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS n_runs", "'x' AS start")
    got = pr.collapse_runs(docs, rewrite=pr.planted_run)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr(plain_row(*r)) for r in rows)
    assert pr.collapse_runs(docs.limit(0)).count() == 0
    kept = pr.collapse_runs(docs.where("doc_id = 5"), keep_text="left")
    assert [r["left"] for r in kept.collect()] == ["x y", "x y"]


def test_op13_equals_the_plain_version(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op13_periodic_runs"](spark, SMALL)
    assert got.columns == ["doc_id", *pr.NAMES]
    want = {r["doc_id"]: plain_row(r["doc_id"], r["text"]) for r in docs if len(r["text"] or "") < 4_000}
    rows = {r["doc_id"]: tuple(r) for r in got.collect()}
    assert len(rows) == len(docs)
    assert {k: rows[k] for k in want} == want
    assert any(r[1] for r in want.values())


# -- op12

def plain_lines(rows, threshold=3, least=20):
    """(doc_id, n_lines, n_dropped, sha) of rows (doc_id, text); an id is one document."""
    def key(line):
        k = line.strip(" \t\n\x0b\x0c\r")
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in k)

    low = float("-inf")
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least:
                holders.setdefault(key(line), set()).add(low if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(holders.get(key(x), ())) >= threshold
                                         and max(holders[key(x)]) != (low if i is None else i))]
        out.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept).encode())))
    return sorted(out, key=repr)


COMMON = "This very line is found in many documents"
ROWS = [
    (1, COMMON + "\nown line of the first document here\n\n" + COMMON), (2, "  " + COMMON.upper() + "\t\nshort"),
    (3, COMMON + "\r\nanother line that two documents have"), (4, "another line that two documents have"),
    (None, COMMON), (5, None), (6, ""), (7, "\n\n"), (7, "\n\n"), (8, "ÄÖÜ ÄÖÜ ÄÖÜ ÄÖÜ ÄÖÜ Ä"), (9, "äöü äöü äöü äöü äöü ä"),
    (10, "ÄÖÜ ÄÖÜ ÄÖÜ ÄÖÜ ÄÖÜ Ä"), (11, "äöü äöü äöü äöü äöü ä"), (12, "äöü äöü äöü äöü äöü ä"), (13, "äöü äöü äöü äöü äöü ä\n" * 40_000),
    (14, "nineteen characters"), (15, "nineteen characters"), (16, "nineteen characters"),
    (2, "repeated id, other text\n" + COMMON), (17, " " + COMMON), (18, " " + COMMON), (19, " " + COMMON.lower()),
]


def answers(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_line_dedup_of_hard_rows(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA).selectExpr("*", "'x' AS line", "0 AS sign", "1 AS n_lines").repartition(5)
    assert answers(ld.dedup_lines(docs)) == plain_lines(ROWS)
    assert ld.dedup_lines(docs.limit(0)).count() == 0
    texts = {r["doc_id"]: r["left"] for r in ld.dedup_lines(docs, keep_text="left").collect() if r["doc_id"] in (1, 3, 12)}
    assert texts == {1: "own line of the first document here\n", 3: COMMON + "\r\nanother line that two documents have", 12: ""}


def test_all_ids_null_and_text_keys(spark):
    rows = [(None, COMMON)] * 4
    assert answers(ld.dedup_lines(spark.createDataFrame(rows, SCHEMA))) == plain_lines(rows)
    named = spark.createDataFrame([(f"d{i}", COMMON) for i in range(4)], "doc_id string, text string")
    assert [r["n_dropped"] for r in ld.dedup_lines(named).orderBy("doc_id").collect()] == [1, 1, 1, 0]


def test_index_is_reversible(spark):
    """Inserting in batches and deleting again leaves exactly the counts and filters of the documents that are there."""
    rng = random.Random(5)
    pool = [f"line number {i} with some more words" for i in range(60)]
    rows = [(i, "\n".join(rng.sample(pool, rng.randint(1, 12)))) for i in range(120)]
    frame = lambda part: spark.createDataFrame(part, SCHEMA)
    index = ld.LineIndex(spark, frame(rows).schema["doc_id"].dataType)
    index.insert(frame(rows[:40]))
    index.insert(frame(rows[40:]))
    index.delete(frame(rows[10:90]).select("doc_id"))
    index.delete(spark.createDataFrame([(5000,), (11,)], "doc_id long"))  # not there, or no more
    again = [(3, pool[0] + "\n" + pool[1]), (200, pool[2])]
    index.insert(frame(again))  # document 3 is replaced
    left = [r for r in rows[:10] + rows[90:] if r[0] != 3] + again
    assert answers(index.clean(frame(left))) == plain_lines(left)
    fresh = ld.LineIndex(spark, frame(rows).schema["doc_id"].dataType)
    fresh.insert(frame(left))
    assert answers(index.counts()) == answers(fresh.counts())
    reopened = ld.LineIndex(spark, frame(rows).schema["doc_id"].dataType, index.path)
    assert answers(reopened.repeated()) == answers(fresh.repeated())
    held = [bytes(r["line"]) for r in fresh.repeated().collect()]
    at = np.frombuffer(b"".join(held), np.uint8).reshape(-1, 16)
    assert reopened.filters().may_hold(at).all()
    gone = spark.createDataFrame([(i,) for i, _ in left], "doc_id long")
    reopened.delete(gone)
    assert reopened.counts().count() == 0 and not reopened.filters().may_hold(at).any()


def test_filters_too_large_to_send_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(ld, "MOST_FILTER_BYTES", 0)
    monkeypatch.setattr(ld, "LINES_PER_SHARD", 2)
    docs = spark.createDataFrame(ROWS, SCHEMA)
    index = ld.LineIndex(spark, docs.schema["doc_id"].dataType)
    index.insert(docs)
    assert index.filters() is None
    assert answers(index.clean(docs)) == plain_lines(ROWS)


@settings(max_examples=15, deadline=None)
@given(st.integers(0, 1 << 30), st.sampled_from([16, 64, 256]))
def test_cuckoo_filter_holds_what_was_added(seed, buckets):
    rng = random.Random(seed)
    lines = list({rng.randbytes(16) for _ in range(600)})
    held = ld.CuckooFilter(buckets)
    for x in lines:
        held.add(x)
    assert all(x in held for x in lines)
    for x in lines[:400]:
        held.remove(x)
    assert all(x in held for x in lines[400:])
    at = np.frombuffer(b"".join(lines), np.uint8).reshape(-1, 16)
    whole = ld.FilterSet(1, buckets, {0: held.dump()})
    assert whole.may_hold(at).tolist() == [x in held for x in lines]
    for x in lines[400:]:
        held.remove(x)
    assert not any(x in held for x in lines)
    with pytest.raises(KeyError):
        held.remove(lines[0])


def test_cuckoo_filter_seldom_errs():
    rng = random.Random(2)
    held = ld.CuckooFilter(4096)
    for _ in range(12_000):
        held.add(rng.randbytes(16))
    assert len(held.tables) == 1  # three quarters full
    assert sum(rng.randbytes(16) in held for _ in range(20_000)) < 20
