"""Language, toxicity, decontamination, fingerprints and licences."""

import collections
import hashlib
import re
import textwrap
import zlib

import numpy as np
import pytest

from tests.oracle import compare, connect
from tidemark.llm import decontaminate, langid, licences, quartile_digest, queries, toxicity
from tidemark.llm.common import WordHasher, maybe_in

DOCS = "doc_id long, text string, lang string, score double, k0 string"
ODD = [(1, "the cat and the dog went over the hill", "en", 0.0, "x"), (1, "the cat and the dog went over the hill", "en", 0.0, "x"),
       (2, None, "en", 0.0, "x"), (3, "", None, 0.0, "x"), (4, "12 34 !!", "en", 0.0, "x"), (None, "der Hund und die Katze", "de", 0.0, "x"),
       (5, "word " * 60000, "en", 0.0, "x"), (6, "x" * 70000, None, 0.0, None), (7, "é中\U0001F600", "fr", 0.0, "x")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


def _bucket(key, modulus):
    return zlib.crc32(str(key).encode()) % modulus


# language


def test_gradients_match_finite_differences():
    model = langid.new_model(["a", "b"], hidden=3, seed=1)
    rng = np.random.default_rng(2)
    tokens = rng.integers(97, 110, (6, 4)).astype(np.intp)
    tokens[4:, 0] = langid.PAD
    target = np.array([0, 1, 1, 0])

    def loss():
        prob = langid.position_probabilities(model, tokens)
        own = np.log(prob[:, target, np.arange(4)])
        mask = tokens != langid.PAD
        return -(own * mask).sum() / mask.sum()

    grads = langid._gradients(model, tokens, target)
    weights = [model.x[0], model.u[0], model.x[1], model.u[1], model.out, model.bias]
    for w, g in zip(weights, grads):
        for spot in zip(*np.unravel_index(np.argsort(-np.abs(g), axis=None)[:3], g.shape)):
            kept = w[spot]
            w[spot] = kept + 1e-2
            up = loss()
            w[spot] = kept - 1e-2
            down = loss()
            w[spot] = kept
            assert abs((up - down) / 2e-2 - g[spot]) < 0.02 * max(0.05, abs(g[spot])) + 2e-3


def test_language_held_out_accuracy(spark, sf):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.QUERIES["op2_language_id"](spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(truth)
    assert all(r.held_out == (_bucket(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.93


def test_language_of_odd_rows(spark, odd):
    model = langid.fit([b"the cat and the dog " * 9, b"der Hund und die Katze " * 9], ["en", "de"], steps=60)
    rows = langid.predict(odd, model, spans=True).collect()
    found = collections.Counter((r.doc_id, r.lang_pred) for r in rows)
    assert found[(1, "en")] == 2 and found[(None, "de")] == 1
    assert all(r.lang_pred == "und" and r.score == 0 for r in rows if r.doc_id in (2, 3, 4))
    for r in rows:
        size = len((next(t for i, t, *_ in ODD if i == r.doc_id) or "").encode())
        assert sum(s.length for s in r.spans) == (0 if r.lang_pred == "und" else size)
    assert {r.lang_pred for r in langid.predict(odd, None).collect()} == {"und"}
    assert langid.predict(odd.limit(0), model).collect() == []
    assert langid.train(odd.where("lang IS NULL")) is None


def test_long_text_equals_its_segments(spark):
    model = langid.fit([b"abc " * 40, b"xyz " * 40], ["a", "b"], steps=40)
    text = "abc xyz " * 5000
    [row] = langid.predict(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).collect()
    data = np.frombuffer(text.encode(), np.uint8)
    rows, _ = langid.segments(data, np.array([0, len(data)]))
    prob = langid.position_probabilities(model, rows.T.astype(np.intp)).mean(axis=(0, 2))
    assert abs(row.score - prob.max()) < 1e-4


# toxicity


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.QUERIES["op8_toxicity"](spark, sf).collect()
    assert all(r.held_out == (_bucket(r.doc_id, 5) == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    marked = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and truth.get(r.doc_id) is not None]
    assert np.mean([p == t for p, t in marked]) > 0.98
    # of the texts marked toxic here, about one in fifteen holds no toxic word at all
    assert np.mean([p for p, t in marked if t]) > 0.85


def test_toxicity_thresholds_from_all_labelled_texts(spark):
    """The thresholds are those of the plain rule over every labelled text left out, not of a sample."""
    from pyspark.sql import functions as F
    words = ["fine", "good", "calm", "vile", "mean", "grim", "plain", "word", "text", "day"]
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.concat_ws(" ", *[F.element_at(
            F.array(*map(F.lit, words)), (F.pmod(F.xxhash64("id", F.lit(k)), F.lit(10)) + 1).cast("int")) for k in range(4)]).alias("text"))
    labels = docs.select("doc_id", F.when(F.col("text").contains("vile") != (F.col("doc_id") % 9 == 0), 1).otherwise(0).alias("toxic"))
    model = toxicity.train(docs, labels, per_class=60, steps=40)
    left_out = docs.join(labels, "doc_id").where(toxicity._spread("doc_id") % 5 == 4).collect()
    assert len(left_out) > 400
    rows, counts = toxicity.hashed_words(*toxicity.lowered([r.text for r in left_out]), WordHasher(toxicity.SEPARATORS))
    plain = toxicity.Model(**vars(model))
    toxicity._calibrate(plain, rows, counts, np.array([r.toxic for r in left_out], float))
    assert model.thresholds == pytest.approx(plain.thresholds, abs=1e-4)


def test_toxicity_best_thresholds(spark):
    rows = [(0, 0.9, 1), (0, 0.8, 0), (0, 0.7, 1), (0, 0.3, 0), (1, 0.6, 1), (1, 0.2, 0), (2, 0.5, 0)]
    found = toxicity.best_thresholds(spark.createDataFrame(rows, "language int, score double, label int"))
    assert {k: (round(v[0], 9), *v[1:]) for k, v in found.items()} == {
        0: (0.5, 2, 2), 1: (0.4, 1, 1), 2: (0.25, 0, 1), -1: (0.55, 3, 4)}


def test_toxicity_odd_rows(spark, odd):
    texts = [f"good word{k} text" for k in range(40)] + [f"bad{k % 3} vile{k} text" for k in range(40)]
    model = toxicity.fit(texts, [0] * 40 + [1] * 40, ["en", None] * 40, steps=100)
    rows = toxicity.predict(odd, model).collect()
    assert len(rows) == len(ODD) and len({r.score for r in rows if r.doc_id == 1}) == 1
    assert len({r.score for r in rows if r.doc_id in (2, 3)}) == 1
    assert toxicity.predict(odd.limit(0), model).collect() == []
    assert {r.score for r in toxicity.predict(odd, None).collect()} == {0.0}
    none = spark.createDataFrame([(1, None), (2, 7)], "doc_id long, toxic int")
    assert toxicity.train(odd, none) is None


def test_pooling_does_not_depend_on_batches():
    texts = ["", "one", "one two", "a b c d " * 3000, "x y z"]
    model = toxicity.fit(["fine text here", "vile text here"] * 30, [0, 1] * 30, ["en"] * 60, steps=30)
    hasher = WordHasher(toxicity.SEPARATORS)
    rows, counts = toxicity.hashed_words(*toxicity.lowered(texts), hasher)
    together = toxicity.features(model, rows, counts, words_at_once=500)
    at = np.concatenate([[0], np.cumsum(counts)])
    for k in range(len(texts)):
        alone = toxicity.features(model, rows[at[k]:at[k + 1]], counts[k:k + 1])
        assert np.allclose(together[k], alone[0], atol=1e-5)


# decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _hits(docs, items):
    windows = collections.defaultdict(set)
    for item, text in items:
        words = WORD.findall((text or "").translate(LOWER))
        for k in range(max(1, len(words) - 9) if words else 0):
            windows[tuple(words[k:k + 10])].add(item)
    out = []
    for doc, text in docs:
        words = WORD.findall((text or "").translate(LOWER))
        hit, found = [False] * len(words), set()
        for size in {len(w) for w in windows}:
            for k in range(len(words) - size + 1):
                own = windows.get(tuple(words[k:k + size]))
                if own:
                    found |= own
                    hit[k:k + size] = [True] * size
        names = sorted(str(i) for i in found if i is not None)
        out.append((doc, len(words), sum(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), any(hit)))
    return sorted(out, key=str)


def _found(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()), key=str)


def test_decontamination_query_equals_brute_force(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert _found(queries.QUERIES["op3_decontamination"](spark, sf)) == _hits(docs, items)


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_short_and_odd_items(spark, odd, block_bytes):
    items = [(1, "The cat"), (2, "cat"), (2, "dog over"), (3, None), (4, "!!!"), (5, "word " * 30), (6, "word"), (None, "hund"),
             (7, "THE DOG WENT"), (7, "THE DOG WENT"), (8, "é中"), (9, "went over the hill and then some more words follow here")]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(odd, decontaminate.Benchmark(table, block_bytes=block_bytes), spans=True)
    assert _found(got) == _hits([r[:2] for r in ODD], items)
    assert all(sum(s.words for s in r.spans) == r.n_hit for r in got.collect())


def test_random_patterns_are_all_found():
    rng = np.random.default_rng(3)
    words = [bytes(rng.integers(97, 100, rng.integers(1, 4))).decode() for _ in range(60)]
    docs = [(k, " ".join(rng.choice(words, 300))) for k in range(20)]
    items = [(k, " ".join(rng.choice(words, rng.integers(1, 14)))) for k in range(30)]
    items += [(99, " ".join(docs[3][1].split()[40:70]))]
    n, covered, found = decontaminate.search([decontaminate.build(items)], [t for _, t in docs])
    want = {d: (a, b, c) for d, a, b, c, *_ in _hits(docs, items)}
    assert {k: (n[k], 0 if covered[k] is None else int(covered[k].sum()), len(found[k])) for k in range(20)} == want


def test_empty_tables(spark, odd):
    empty = decontaminate.Benchmark(spark.createDataFrame([], "item_id long, text string"))
    assert not any(r.contaminated for r in decontaminate.contamination(odd, empty).collect())
    full = decontaminate.Benchmark(spark.createDataFrame([(1, "the")], "item_id long, text string"))
    assert decontaminate.contamination(odd.limit(0), full).collect() == []


# fingerprints


def _edits(rows):
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for k, (doc, text) in enumerate(order):
        after = order[(k + 1) % len(order)][1] or ""
        changed = quartile_digest.edited(text or "", after)
        prints = [quartile_digest.fingerprint(t.encode()) for t in (text or "", changed, after)]
        out[doc] = (len(text or ""), hashlib.sha256(changed.encode()).hexdigest(), *prints[:2],
                    float(quartile_digest.likeness(prints[:1], prints[1:2])[0]),
                    float(quartile_digest.likeness(prints[:1], prints[2:])[0]))
    return out


def _prints(df):
    return {r.doc_id: (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next)
            for r in df.collect()}


def test_fingerprint_query_equals_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = _prints(queries.QUERIES["op5_quartile_digest"](spark, sf))
    assert got == _edits(rows)
    assert np.mean([v[4] > v[5] for v in got.values()]) > 0.95


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_fingerprints_of_few_and_null_texts(spark, n):
    rows = [(4, "abcdef"), (9, None), (2, "é" * 7)][:n]
    got = quartile_digest.compare_with_next(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, part string"))
    assert _prints(got) == _edits(rows)


def test_fingerprints_keep_repeated_and_null_keys(spark, odd):
    rows = quartile_digest.compare_with_next(odd).collect()
    assert len(rows) == len(ODD)
    assert len({r.fingerprint for r in rows if r.doc_id == 1}) == 1
    assert all(0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1 for r in rows)


def test_difference_is_bounded_and_symmetric():
    rng = np.random.default_rng(5)
    prints = [quartile_digest.fingerprint(bytes(rng.integers(0, 256, n))) for n in (0, 1, 2, 3, 50, 5000, 1 << 21)]
    for a in prints:
        for b in prints:
            d = quartile_digest.difference([a], [b])[0]
            assert 0 <= d <= quartile_digest.MOST and d == quartile_digest.difference([b], [a])[0] and (a == b) == (d == 0)


# licences


def test_licence_query_equals_sql(spark, sf):
    assert compare(queries.QUERIES["op6_licence_digests"](spark, sf), connect(sf), queries.SQL["op6_licence_digests"]) == []


def test_whole_licences_in_other_spellings(spark):
    text = "Copyright (c) 2020 Someone\n\n" + licences._MIT.upper().replace("SUBLICENSE", "sublicence").replace(",", " ,")
    rows = [(1, text), (2, "some prose\n  RELEASED under the MIT licence!\nmore"), (3, None), (4, ""), (5, text + " extra"),
            (2, "some prose\n  RELEASED under the MIT licence!\nmore"), (None, "Licensed under CC BY-NC 4.0.")]
    got = licences.scan(spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, licence string")).collect()
    found = sorted(((r.doc_id, r.text_licence, r.n_notices, r.line_licences) for r in got), key=str)
    assert found == sorted([(1, "MIT", 0, None), (2, None, 1, "MIT"), (2, None, 1, "MIT"), (3, None, 0, None), (4, None, 0, None),
                            (5, None, 0, None), (None, "CC-BY-NC-4.0", 1, "CC-BY-NC-4.0")], key=str)
    assert licences.scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_standard_licence_files_in_several_wrappings(spark):
    """Whole files with titles and notices, wrapped by words at any width, and prose that is no notice."""
    files = {name: text for name, text in licences._texts() if "END OF TERMS" in text or name in ("MPL-2.0", "Unlicense", "CC0-1.0")}
    rows = []
    for licence, text, title in (("MIT", licences._MIT, "MIT License"), ("ISC", licences._ISC, "ISC License (ISC)"),
                                 ("MIT", licences._MIT, "# The MIT License (MIT)"),
                                 ("BSD-3-Clause", f"{licences._BSD_HEAD}\n{licences._BSD_NAME}\n{licences._BSD_TAIL}",
                                  'BSD 3-Clause "New" or "Revised" License')):
        bodies = [text, " ".join(text.split()), *(textwrap.fill(" ".join(text.split()), n) for n in range(20, 130, 3)),
                  " ".join(text.split()).replace(" COPYRIGHT HOLDER", "\nCOPYRIGHT HOLDER").replace(" copyright ", "\n  copyright ")]
        heads = ["", f"{title}\n\n", f"{title}\n\nCopyright (c) 2020 Someone\n\n", "Copyright The Some Authors\nAll rights reserved.\n",
                 f"{title}\n=====\n\nCopyright 2019, 2020 A\nCopyright by B Ltd.\n(c) C\n\n", "© 2020 Someone. All rights reserved.\n"]
        rows += [(licence, head + body) for head in heads for body in bodies]
    rows += files.items()
    rows.append(("Apache-2.0", files["Apache-2.0"].replace("[yyyy] [name of copyright owner]", "2021 Someone")))
    rows.append((None, licences._MIT.replace("COPYRIGHT HOLDERS", "NO ONE")))
    rows.append((None, "The MIT License\nis not what follows here.\n" + "\n" * 20000 + "copyright\n" * 20000))
    df = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r.text_licence for r in licences.scan(df).collect()}
    assert [(k, want, got[k], rows[k][1][:60]) for k, (want, _) in enumerate(rows) if got[k] != want] == []


# helpers


def test_word_hashes_equal_hashes_of_single_words():
    hasher = WordHasher(b" ")
    words = [b"a", b"ab", b"ba", b"a" * 3000, b"x" * (WordHasher.BLOCK + 5), b"ab", b"\xc3\xa9"] + [b"w%d" % k for k in range(2000)]
    buf = np.frombuffer(b" ".join(words), np.uint8)
    starts, ends = hasher.words(buf)
    assert [bytes(buf[s:e]) for s, e in zip(starts, ends)] == words
    [got] = hasher.hash(buf, starts, ends)
    for k in (0, 1, 2, 3, 4, 5, 6, 1000):
        one = np.frombuffer(words[k], np.uint8)
        assert hasher.hash(one, np.array([0]), np.array([len(one)]))[0][0] == got[k]
    assert got[1] == got[5] and len(set(got.tolist())) == len(set(words))


def test_bitmap_never_misses_a_key(spark):
    keys = spark.range(0, 3000, 3).toDF("k")
    for bits in (1 << 15, 1 << 20):
        flagged = maybe_in(spark.range(3000).toDF("id"), "id", keys, "f", most_bits=bits)
        assert flagged.where("id % 3 = 0 AND NOT f").count() == 0 and flagged.count() == 3000
        assert flagged.where("f").count() < 1600
