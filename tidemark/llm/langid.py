"""Language identification with a bidirectional gated recurrent network over bytes.

Two gated recurrent layers read a text forwards and backwards; from both states every byte gets
a probability per language, and a document's probabilities are the mean over its bytes. Texts are
read in segments of ``SEGMENT`` bytes, each with fresh states, so thousands of segments advance side
by side in numpy and a text of any length takes the same memory. Training is back-propagation
through time in numpy, on the driver, over a bounded sample; prediction runs in Spark tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import arrow_input, arrow_output, fit_in_task, small_batches, text_buffers

SEGMENT = 64
HIDDEN = 8
PAD = 256
UNDETERMINED = "und"


@dataclass
class Model:
    """Per direction: ``x`` (3H, 257) input weights of update gate, reset gate and candidate, ``u`` (3H, H)
    recurrent weights; ``out`` (K, 2H) and ``bias`` (K, 1) for the languages. Gates are the piecewise linear
    ``clip(a + 1/2, 0, 1)`` and the candidate is ``a / (1 + |a|)``: both cost a fraction of tanh."""

    languages: list[str]
    x: list[np.ndarray]
    u: list[np.ndarray]
    out: np.ndarray
    bias: np.ndarray


def new_model(languages: list[str], hidden: int = HIDDEN, seed: int = 7) -> Model:
    rng = np.random.default_rng(seed)

    def normal(scale, *shape):
        return (scale * rng.standard_normal(shape)).astype(np.float32)

    return Model(languages, [normal(0.5, 3 * hidden, PAD + 1) for _ in range(2)],
                 [normal(0.5 / hidden ** 0.5, 3 * hidden, hidden) for _ in range(2)],
                 normal(0.3, len(languages), 2 * hidden), np.zeros((len(languages), 1), np.float32))


def _layer(x: np.ndarray, u: np.ndarray, tokens: np.ndarray, order, keep=None) -> np.ndarray:
    """States (T, H, B) of one direction for tokens (T, B). ``keep`` collects what training needs."""
    steps, width = tokens.shape
    hidden = u.shape[1]
    states = np.empty((steps, hidden, width), np.float32)
    h = np.zeros((hidden, width), np.float32)
    a, g = np.empty((3 * hidden, width), np.float32), np.empty((3 * hidden, width), np.float32)
    for t in order:
        np.take(x, tokens[t], axis=1, out=a, mode="clip")
        np.matmul(u, h, out=g)
        gates = a[:2 * hidden]
        gates += g[:2 * hidden]
        gates += np.float32(0.5)
        np.clip(gates, 0, 1, out=gates)
        update, reset = gates[:hidden], gates[hidden:]
        new = reset * g[2 * hidden:]
        new += a[2 * hidden:]
        size = np.abs(new)
        size += np.float32(1)
        new /= size
        if keep is not None:
            keep[t] = (h.copy(), gates.copy(), new.copy(), g[2 * hidden:].copy())
        np.subtract(h, new, out=states[t])
        states[t] *= update
        states[t] += new
        h = states[t]
    return states


def _softmax(logits: np.ndarray) -> np.ndarray:
    """Over axis -2, in place."""
    np.clip(logits, -60, 60, out=logits)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=-2, keepdims=True)
    return logits


def position_probabilities(model: Model, tokens: np.ndarray) -> np.ndarray:
    """Probability of each language at each position: (T, K, B) for tokens (T, B)."""
    steps = len(tokens)
    forward = _layer(model.x[0], model.u[0], tokens, range(steps))
    backward = _layer(model.x[1], model.u[1], tokens, range(steps - 1, -1, -1))
    h = forward.shape[1]
    logits = np.matmul(model.out[:, :h], forward)
    logits += np.matmul(model.out[:, h:], backward)
    logits += model.bias
    return _softmax(logits)


def _gradients(model: Model, tokens: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean cross-entropy over all text positions, by back-propagation through time."""
    steps, width = tokens.shape
    kept = [[None] * steps, [None] * steps]
    orders = [range(steps), range(steps - 1, -1, -1)]
    states = [_layer(model.x[d], model.u[d], tokens, orders[d], kept[d]) for d in range(2)]
    h = states[0].shape[1]
    both = np.concatenate(states, axis=1)
    prob = _softmax(np.matmul(model.out, both) + model.bias)
    mask = (tokens != PAD).astype(np.float32)
    delta = prob
    delta[:, target, np.arange(width)] -= 1
    delta *= (mask / max(1.0, mask.sum()))[:, None, :]
    d_out = np.matmul(delta, both.transpose(0, 2, 1)).sum(axis=0)
    d_bias = delta.sum(axis=(0, 2))[:, None]
    d_both = np.matmul(model.out.T, delta)
    grads = []
    for d in range(2):
        dx, du = np.zeros_like(model.x[d]), np.zeros_like(model.u[d])
        dh = np.zeros((h, width), np.float32)
        pre = np.empty((steps, 3 * h, width), np.float32)
        for t in reversed(orders[d]):
            dh = dh + d_both[t, d * h:(d + 1) * h]
            before, gates, new, carried = kept[d][t]
            update, reset = gates[:h], gates[h:]
            d_new = dh * (1 - update) * (1 - np.abs(new)) ** 2
            slope = (gates > 0) & (gates < 1)
            pre[t, :h] = dh * (before - new) * slope[:h]
            pre[t, h:2 * h] = d_new * carried * slope[h:]
            pre[t, 2 * h:] = d_new
            through = pre[t].copy()
            through[2 * h:] *= reset
            du += through @ before.T
            dh = dh * update + model.u[d].T @ through
        flat = pre.transpose(1, 0, 2).reshape(3 * h, -1)
        which = tokens.reshape(-1)
        for row in range(3 * h):
            dx[row] = np.bincount(which, flat[row], minlength=PAD + 1)
        grads += [dx, du]
    return [*grads, d_out, d_bias]


def segments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts cut into rows of SEGMENT bytes, the last one of each filled with PAD; rows per text."""
    sizes = np.diff(offsets)
    count = -(-sizes // SEGMENT)
    out = np.full(int(count.sum()) * SEGMENT, PAD, np.int16)
    at = 0
    for k, n in enumerate(sizes):
        out[at:at + n] = data[offsets[k]:offsets[k + 1]]
        at += int(count[k]) * SEGMENT
    return out.reshape(-1, SEGMENT), count


def fit(texts: list[bytes], labels: list[str], steps: int = 260, batch: int = 256, rate: float = 0.02,
        hidden: int = HIDDEN, seed: int = 7) -> Model:
    """Train on texts with their languages: Adam over random segments, languages drawn evenly."""
    languages = sorted(set(labels))
    model = new_model(languages, hidden, seed)
    rng = np.random.default_rng(seed)
    by_language = []
    for language in languages:
        own = [t for t, label in zip(texts, labels) if label == language and t]
        rows, _ = segments(np.frombuffer(b"".join(own), np.uint8),
                           np.concatenate([[0], np.cumsum([len(t) for t in own])]).astype(np.int64))
        by_language.append(rows if len(rows) else np.full((1, SEGMENT), PAD, np.int16))
    weights = [model.x[0], model.u[0], model.x[1], model.u[1], model.out, model.bias]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        target = rng.integers(0, len(languages), batch)
        tokens = np.stack([by_language[k][rng.integers(0, len(by_language[k]))] for k in target], axis=1).astype(np.intp)
        now = rate * (1 - step / (steps + 1))
        for w, g, m, v in zip(weights, _gradients(model, tokens, target), first, second):
            g = np.clip(g, -1, 1)
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= (now * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-7)).astype(np.float32)
    return model


def training_rows(docs: DataFrame, per_language: int, text: str, lang: str, key: str) -> DataFrame | None:
    """A bounded sample (lang, spread, text) of labelled texts, chosen by a hash of the key: about 1.5 times
    ``per_language`` texts of every language; of each text at most 2,048 characters from a place that the hash
    picks. In order of the hash, in one partition. None without a label.
    """
    labelled = docs.where(F.col(lang).isNotNull())
    counts = labelled.groupBy(lang).count().collect()
    if not counts:
        return None
    spread = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1 << 40))
    share = F.create_map(*[x for r in counts for x in (
        F.lit(r[0]), F.lit(min(1 << 40, int((1.5 * per_language + 64) * (1 << 40) / r["count"]))))])
    n = F.length(text)
    start = F.when(n > 2048, F.pmod(F.xxhash64(F.lit(1), F.col(key).cast("string")), n - 2047)).otherwise(0) + 1
    return (labelled.withColumn("_spread", spread)
            .where((F.col("_spread") < share[F.col(lang)]) & F.col(text).rlike(r"\p{L}"))
            .select(F.col(lang).alias("lang"), "_spread", F.substring(text, start.cast("int"), F.lit(2048)).alias("text"))
            .orderBy("_spread", "lang", "text").limit(4 * (per_language + 64) * len(counts)))


def train(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", per_language: int = 500,
          **settings) -> Model | None:
    """Fit a model on the labelled rows of ``docs``, in a task; None where no row has a language and a letter.
    Every language that has rows is learnt: the sample grows with their number, not with the rows."""
    sample = training_rows(docs, per_language, text, lang, key)

    def learn(rows):
        texts, labels, taken = [], [], {}
        for label, _, body in rows:
            if taken.setdefault(label, 0) < per_language:
                taken[label] += 1
                texts.append(body.encode("utf-8", "replace"))
                labels.append(label)
        return vars(fit(texts, labels, **settings))

    found = None if sample is None else fit_in_task(sample, learn)
    return Model(**found) if found else None


def _has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def predict(docs: DataFrame, model: Model | None, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
            names: tuple[str, ...] = ("lang_pred", "score", "spans"), spans: bool = False,
            lanes: int = 2048) -> DataFrame:
    """``keep`` columns, lang_pred and score (the mean probability of that language over all bytes).

    A null text, a text without letters, and any text when there is no model, get ``und`` and 0. With
    ``spans`` an array ``spans`` of (start, length, lang) in bytes gives the runs of equal position labels.
    Whole texts are read, whatever their length. Repeated rows get equal answers, an empty table gives no
    rows; other columns of ``docs`` are not read, and ``names`` renames the added ones should they clash.
    """
    import pyarrow as pa

    small_batches(docs.sparkSession)
    taken, schema, place = arrow_input(docs, keep, text)
    schema += "p0 string, p1 double" + (", p2 array<struct<start:int,length:int,lang:string>>" * spans)

    def label(batches):
        for batch in batches:
            texts = batch.column(place)
            guess, score, runs = [UNDETERMINED] * len(texts), np.zeros(len(texts)), [[] for _ in range(len(texts))]
            live = [k for k, t in enumerate(texts.to_pylist()) if _has_letter(t)] if model else []
            if live:
                data, offsets = text_buffers(texts.take(pa.array(live)))
                rows, count = segments(data, offsets)
                sums = np.empty((len(rows), len(model.languages)))
                labels = np.empty((len(rows), SEGMENT), np.int16) if spans else None
                for at in range(0, len(rows), lanes):
                    tokens = np.ascontiguousarray(rows[at:at + lanes].T).astype(np.intp)
                    prob = position_probabilities(model, tokens)
                    if spans:
                        labels[at:at + lanes] = prob.argmax(axis=1).T
                    prob *= (tokens != PAD)[:, None, :]
                    sums[at:at + lanes] = prob.sum(axis=0).T
                first = np.concatenate([[0], np.cumsum(count)])[:-1]
                pooled = np.add.reduceat(sums, first, axis=0) / np.diff(offsets)[:, None]
                best = pooled.argmax(axis=1)
                for k, row in enumerate(live):
                    guess[row] = model.languages[best[k]]
                    score[row] = min(1.0, max(0.0, float(pooled[k, best[k]])))
                    if spans:
                        own = labels[first[k]:first[k] + count[k]].reshape(-1)[:offsets[k + 1] - offsets[k]]
                        cut = np.concatenate([[0], np.flatnonzero(np.diff(own)) + 1, [len(own)]])
                        runs[row] = [{"start": int(a), "length": int(b - a), "lang": model.languages[own[a]]}
                                     for a, b in zip(cut[:-1], cut[1:])]
            added = [pa.array(guess, pa.string()), pa.array(score, pa.float64())]
            if spans:
                added.append(pa.array(runs, pa.list_(pa.struct(
                    [("start", pa.int32()), ("length", pa.int32()), ("lang", pa.string())]))))
            yield arrow_output(batch, len(keep), added)

    return taken.mapInArrow(label, schema).toDF(*keep, *names[:2 + spans])
