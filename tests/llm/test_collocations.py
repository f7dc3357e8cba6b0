"""Collocations against counts of every gram by itself."""

import random
import re
from collections import Counter

import pytest

from tests.oracle import compare, connect
from tidemark.llm import collocations as co
from tidemark.llm.queries import QUERIES, SQL

SCHEMA = "text string, lang string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_grams(rows):
    counts = {}
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    counts.setdefault(lang or "und", Counter())[tuple(words[i:i + k])] += 1
    return counts


def plain(rows, least, top=2000):
    out = []
    for lang, f in plain_grams(rows).items():
        n = sum(c for g, c in f.items() if len(g) == 1)
        wanted = {g: c for g, c in f.items() if len(g) > 1 and c >= least}
        inside = set()
        for g, c in wanted.items():
            inside |= {g[i:j] for i in range(len(g)) for j in range(i + 2, len(g) + 1)
                       if j - i < len(g) and c >= wanted.get(g[i:j], 0)}
        ranked = []
        for g, a in wanted.items():
            if g not in inside:
                score, k = min((1000 * a * n // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
                ranked.append((-score, -a, " ".join(g).encode(), a, f[g[:k]], f[g[k:]], n, score))
        for rank, r in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, r[2].decode(), *r[3:]))
    return sorted(out)


def answers(frame):
    return sorted(map(tuple, frame.collect()))


def corpus(seed, n=150):
    rng = random.Random(seed)
    vocab = ["a", "the", "Über", "straße", "x1", "to", "be", "or", "not", "ÉTÉ", "été", "日本", "a b", "a\x0bq", "\x00z"]
    phrases = [[rng.choice(vocab) for _ in range(rng.randint(2, 14))] for _ in range(6)]
    rows = []
    for _ in range(n):
        words = []
        for _ in range(rng.randint(0, 12)):
            words += rng.choice(phrases) if rng.random() < .5 else [rng.choice(vocab)]
            if rng.random() < .3:
                words.append(rng.choice([".", ", ", "\n", "!?", "\t", "  "]))
        rows.append((" ".join(words), rng.choice(["en", "en", "fr", None, "und", ""])))
    return rows


@pytest.mark.parametrize("seed,least,top", [(1, 2, 2000), (2, 5, 2000), (3, 12, 7)])
def test_equal_to_plain_counts(spark, seed, least, top):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = answers(co.collocations(docs, least=least, top=top))
    want = plain([(t, "und" if x is None else x) for t, x in rows if x != ""], least, top)
    assert [r for r in got if r[0]] == want and want


def test_hard_rows(spark):
    rows = [(None, "en"), ("", "en"), ("word", None), ("a b " * 30_000, "en"), ("a b " * 3, None)] + [("to be or not", "fr")] * 4
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS n", "2 AS word", "3 AS g")
    assert answers(co.collocations(docs, least=3)) == plain(rows, 3)
    assert co.collocations(docs, least=10 ** 6).count() == 0
    assert co.collocations(docs.limit(0)).count() == 0


def test_small_buffers_and_many_batches_change_nothing(spark, monkeypatch):
    rows = corpus(4, 300)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    graph = co.Graph(docs, least=3)
    want = {lang: {g: c for g, c in f.items() if len(g) > 1 and c >= 3}
            for lang, f in plain_grams([(t, "und" if x is None else x or "~") for t, x in rows]).items()}
    want = {(("" if lang == "~" else lang), " ".join(g)): c for lang, f in want.items() for g, c in f.items()}
    assert {(r["lang"], r["phrase"]): r["f"] for r in graph.spelled(graph.grams).collect()} == want
    monkeypatch.setattr(co, "BUFFER", 50)
    monkeypatch.setattr(co, "CACHE", 5)
    joined = co._joined
    monkeypatch.setattr(co, "_joined", lambda batches: joined(batches, 3))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        again = co.Graph(docs, least=3)
        assert {(r["lang"], r["phrase"]): r["f"] for r in again.spelled(again.grams).collect()} == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_one_code_for_two_words_is_noticed(spark, monkeypatch):
    first = co.Coder.code
    monkeypatch.setattr(co.Coder, "code", lambda self, w: 7 if self.prefix[:4] == bytes(4) else first(self, w))
    rows = [("one two three", "en")] * 3
    assert answers(co.collocations(spark.createDataFrame(rows, SCHEMA), least=3)) == plain(rows, 3)


def test_unary_paths_are_whole_passages(spark):
    words = [f"p{i}" for i in range(30)]
    rows = [(" ".join([f"x{i}", *words, f"y{i}"]), "en") for i in range(5)] + [(" ".join([*words[:20], f"z{i}"]), "en") for i in range(4)]
    graph = co.Graph(spark.createDataFrame(rows, SCHEMA), least=3)
    assert answers(graph.spelled(graph.paths()).select("phrase", "f")) == [
        (" ".join(words[:20]), 9), (" ".join(words[16:]), 5)]


def test_op11_equals_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert compare(QUERIES["op11_phrase_collocations"](spark, sf), connect(sf), SQL["op11_phrase_collocations"]) == []
