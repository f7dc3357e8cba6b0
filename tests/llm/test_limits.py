"""Long white space, loss-bearing tokens, many languages."""

import pytest
from tokenizers import Tokenizer as Library

from tidemark.llm import langid, packing


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    return Library.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def own():
    return packing.Tokenizer()


def ids(data):
    return memoryview(data).cast("I").tolist()


@pytest.mark.parametrize("blank", ["\n", " ", "\t", "\r", "\x0b", "\x85", "\xa0", " ", "　", " \n", "\t \r\n"])
@pytest.mark.parametrize("shape", ["a{}b", "{}b", "a{}", "{}", "a {}b", "a{}\nb c", "x{}.{} y"])
def test_runs_of_white_space_give_the_ids_of_the_tokenizers_file(own, library, blank, shape):
    for n in (4999, 5000, 5001, 12_000):
        text = shape.replace("{}", blank * (n // len(blank)) + blank[:n % len(blank)])
        assert ids(own.encode(text)) == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("blank", ["\n", " ", "\t", "　", " \n\t"])
def test_two_million_blanks_do_not_end_the_task(own, library, blank):
    text = "a" + blank * (2_000_000 // len(blank)) + "b"
    assert ids(own.encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_loss_limit_binds(spark):
    """Prompts without loss fill sequences beside answers: the limit on loss-bearing tokens is the one that is met."""
    rows = [(i, "word " * 300, None if i % 5 == 4 else (0 if i % 2 else 250)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, answers long").coalesce(1)
    pieces = packing.pack_documents(docs, loss=400, loss_tokens="answers").collect()
    tokens, bears = {p.doc_id: p.doc_tokens for p in pieces}, {r[0]: r[2] for r in rows}
    load, loss, seen = {}, {}, {}
    for p in pieces:
        share = 1.0 if bears[p.doc_id] is None else bears[p.doc_id] / tokens[p.doc_id]
        load[p.sequence_id] = load.get(p.sequence_id, 0) + p.length
        loss[p.sequence_id] = loss.get(p.sequence_id, 0) + p.length * share
        seen[p.doc_id] = seen.get(p.doc_id, 0) + p.length
    assert seen == tokens and max(load.values()) <= 1024 and max(loss.values()) <= 400
    assert sum(x > 350 for x in loss.values()) > len(loss) / 2  # met, while tokens are left
    assert sum(load[k] < 900 for k in load) > 3
    free = packing.pack_documents(docs, loss_tokens="answers").collect()
    assert len({p.sequence_id for p in free}) < len(load)


def test_every_language_is_learnt(spark):
    """Seventy languages, one of them with two texts; none is left out however rare it is."""
    letters = [chr(0x4E00 + 40 * k) * 3 + " " + chr(0x4E01 + 40 * k) * 2 for k in range(70)]
    rows = [(100 * k + i, (letters[k] + " ") * 12, f"l{k:02d}") for k in range(70) for i in range(2 if k == 69 else 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = langid.training_rows(docs, 4, "text", "lang", "doc_id")
    assert {r.lang for r in sample.collect()} == {f"l{k:02d}" for k in range(70)}
    model = langid.train(docs, per_language=4, steps=5)
    assert model.languages == [f"l{k:02d}" for k in range(70)]
