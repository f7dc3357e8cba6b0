"""Toxicity with a convolutional text classifier over hashed words.

Words hash into rows of an embedding table (the word itself, and its first 4, 5 and 6 bytes, so that
inflected forms share a row). Filters of several widths slide over the words, the strongest answer of
each filter in the whole text is kept (max pooling), and a logistic unit weighs them. Everything is
trained by gradient descent in numpy, in a task, over a bounded sample of labelled texts; scoring runs in
Spark tasks over whole texts.

The threshold is calibrated by language, on every labelled text of the fifth that training leaves out. The language comes from the text alone (hashed word counts
per language), and the score is bent so that each language's threshold becomes 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import WordHasher, arrow_input, arrow_output, fit_in_task, small_batches, text_buffers
from tidemark.operators.running import running_totals
from tidemark.sources.sinks import scratch

ROWS = 1 << 16
DIM = 16
WIDTHS = (1, 2, 3)
FILTERS = 8
PREFIXES = (4, 5, 6)
#: Bytes between words: ASCII other than digits and letters.
SEPARATORS = bytes(b for b in range(128) if not chr(b).isalnum())


def hashed_words(data: np.ndarray, offsets: np.ndarray, hasher: WordHasher) -> tuple[np.ndarray, np.ndarray]:
    """Table rows (words, 1 + len(PREFIXES)) of lower-cased texts, and the number of words of each text."""
    spaced = np.full(len(data) + len(offsets) - 1, 32, np.uint8)
    starts_of = offsets[:-1] + np.arange(len(offsets) - 1)
    spaced[np.arange(len(data)) + np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))] = data
    starts, ends = hasher.words(spaced)
    hashes = hasher.hash(spaced, starts, ends, *(np.minimum(starts + p, ends) for p in PREFIXES))
    for k, p in enumerate(PREFIXES):  # a prefix is not the word of the same letters
        hashes[k + 1] = hashes[k + 1] * np.uint64(2 * p + 1) + np.uint64(p)
    rows = np.stack([(h >> np.uint64(40)) % np.uint64(ROWS) for h in hashes], axis=1).astype(np.intp)
    bounds = np.searchsorted(starts, np.append(starts_of, len(spaced)))
    return rows, np.diff(bounds)


def lowered(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    import pyarrow as pa

    return text_buffers(pa.array([(t or "").lower() for t in texts], pa.large_string()))


@dataclass
class Model:
    table: np.ndarray  # (ROWS, DIM)
    filters: list[np.ndarray]  # per width (width, DIM, FILTERS)
    shift: np.ndarray  # (len(WIDTHS) * FILTERS,)
    weigh: np.ndarray
    bias: float
    languages: list[str] = field(default_factory=list)
    language_table: np.ndarray | None = None  # (ROWS, K) log odds of a word per language
    thresholds: np.ndarray | None = None  # per language


def _responses(model: Model, rows: np.ndarray, counts: np.ndarray):
    """Filter answers (words, filters) with the words' vectors, and the first word of each text that has words."""
    gap = max(WIDTHS) - 1
    doc = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(rows)) + doc * gap
    vectors = np.zeros((len(rows) + len(counts) * gap, DIM), np.float32)
    vectors[place] = model.table[rows[:, 0]]
    for k in range(1, rows.shape[1]):
        vectors[place] += model.table[rows[:, k]]
    kernel = np.concatenate([f[k] for f in model.filters for k in range(len(f))], axis=1)
    parts = vectors @ kernel
    out, at = np.empty((len(vectors), len(WIDTHS) * FILTERS), np.float32), 0
    for w, width in enumerate(WIDTHS):
        own = out[:, w * FILTERS:(w + 1) * FILTERS]
        own[:] = parts[:, at:at + FILTERS]
        for k in range(1, width):
            own[:-k] += parts[k:, at + k * FILTERS:at + (k + 1) * FILTERS]
        at += width * FILTERS
    first = np.concatenate([[0], np.cumsum(counts + gap)])[:-1]
    return vectors, out, first


def features(model: Model, rows: np.ndarray, counts: np.ndarray, words_at_once: int = 1 << 16) -> np.ndarray:
    """Pooled answers (texts, filters); a text without words has zeros."""
    pooled = np.zeros((len(counts), len(WIDTHS) * FILTERS), np.float32)
    at, done = 0, 0
    while at < len(counts):
        to, size = at, 0
        while to < len(counts) and (to == at or size + counts[to] <= words_at_once):
            size += int(counts[to])
            to += 1
        if to == at + 1 and size > words_at_once:  # one very long text: pooled piece by piece
            best = np.full(pooled.shape[1], -np.inf, np.float32)
            overlap = max(WIDTHS) - 1
            for k in range(0, size, words_at_once):
                part = rows[done + k:done + min(size, k + words_at_once + overlap)]
                answers = _responses(model, part, np.array([len(part)]))[1]
                best = np.maximum(best, answers[:min(words_at_once, size - k)].max(axis=0))
            pooled[at] = best
        elif size:
            own = counts[at:to]
            live = np.flatnonzero(own)
            _, answers, first = _responses(model, rows[done:done + size], own)
            gap = max(WIDTHS) - 1
            cuts = np.stack([first[live], first[live] + own[live]], axis=1).reshape(-1)
            pooled[at + live] = np.maximum.reduceat(np.concatenate([answers, answers[:1]]), cuts, axis=0)[::2] \
                if gap else np.maximum.reduceat(answers, first[live], axis=0)
        done += size
        at = to
    pooled[counts > 0] = np.maximum(pooled[counts > 0] + model.shift, 0)
    return pooled


def raw_scores(model: Model, rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(features(model, rows, counts) @ model.weigh + model.bias, -30, 30)))


def language_of(model: Model, rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Index of the likeliest language of each text, from its words; 0 without words."""
    out = np.zeros(len(counts), np.intp)
    live = np.flatnonzero(counts)
    if len(live) and len(model.languages) > 1:
        first = np.concatenate([[0], np.cumsum(counts)])[:-1][live]
        out[live] = np.add.reduceat(model.language_table[rows[:, 0]], first, axis=0).argmax(axis=1)
    return out


def scores(model: Model, rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Scores bent so that the threshold of a text's language is 0.5."""
    raw = raw_scores(model, rows, counts)
    cut = model.thresholds[language_of(model, rows, counts)]
    return np.where(raw < cut, 0.5 * raw / cut, 0.5 + 0.5 * (raw - cut) / (1 - cut))


def _start(rows: np.ndarray, counts: np.ndarray, labels: np.ndarray, rng) -> Model:
    """Small random weights; the first dimension of a table row starts from its log odds among the labels."""
    doc = np.repeat(np.arange(len(counts)), counts)
    yes, no = np.zeros(ROWS), np.zeros(ROWS)
    for column in rows.T:
        pairs = np.unique(doc * ROWS + column)
        yes += np.bincount(pairs % ROWS, labels[pairs // ROWS], ROWS)
        no += np.bincount(pairs % ROWS, 1 - labels[pairs // ROWS], ROWS)
    yes, no = np.minimum(yes, labels.sum()), np.minimum(no, (1 - labels).sum())
    odds = np.log((yes + 1) / (labels.sum() + 2)) - np.log((no + 1) / ((1 - labels).sum() + 2))
    sure = np.sqrt(yes + no) / (np.sqrt(yes + no) + 3)
    table = (0.05 * rng.standard_normal((ROWS, DIM))).astype(np.float32)
    table[:, 0] += (np.clip(odds, -3, 3) * sure).astype(np.float32) * 0.3
    filters = [(0.2 * rng.standard_normal((w, DIM, FILTERS))).astype(np.float32) for w in WIDTHS]
    for f in filters:
        f[:, 0] += 0.3
    n = len(WIDTHS) * FILTERS
    return Model(table, filters, np.zeros(n, np.float32), (0.3 * rng.standard_normal(n)).astype(np.float32), 0.0)


def fit(texts: list[str], labels: list[int], languages: list[str | None], steps: int = 700, batch: int = 32,
        rate: float = 0.05, seed: int = 11, held: list[bool] | None = None) -> Model:
    """Train filters, table and output by Adagrad; every fifth text, or those that ``held`` names, only sets the
    thresholds (from 50 texts on)."""
    rng = np.random.default_rng(seed)
    hasher = WordHasher(SEPARATORS)
    rows, counts = hashed_words(*lowered(texts), hasher)
    rows = rows.astype(np.int32)
    at = np.concatenate([[0], np.cumsum(counts)])
    y = np.asarray(labels, np.float64)
    held = np.arange(len(y)) % 5 == 4 if held is None else np.asarray(held, bool)
    held &= len(y) >= 50

    def some(which):
        return (np.concatenate([rows[at[k]:at[k + 1]] for k in which]) if len(which) else rows[:0]), counts[which]

    learn = np.flatnonzero(~held)
    own_rows, own_counts = some(learn)
    model = _start(own_rows, own_counts, y[learn], rng)
    sums = [np.full_like(p, 1e-2) for p in (model.table, *model.filters, model.shift, model.weigh)]
    bias_sum, n_filters = 1e-2, len(WIDTHS) * FILTERS
    share = np.clip(y[learn].mean(), 0.02, 0.98) if len(learn) else 0.5
    for _ in range(-(-steps * batch // max(1, len(learn)))):
        order = rng.permutation(learn)
        for b in range(0, len(order), batch):
            which = order[b:b + batch]
            which = which[counts[which] > 0]
            if not len(which):
                continue
            part, sizes = some(which)
            vectors, answers, first = _responses(model, part, sizes)
            top = np.stack([s + answers[s:s + c].argmax(axis=0) for s, c in zip(first, sizes)])  # (texts, filters)
            pooled = answers[top, np.arange(n_filters)] + model.shift
            act = np.maximum(pooled, 0)
            prob = 1 / (1 + np.exp(-np.clip(act @ model.weigh + model.bias, -30, 30)))
            weight = np.where(y[which] > 0, 0.5 / share, 0.5 / (1 - share))
            error = ((prob - y[which]) * weight / len(which)).astype(np.float32)
            d_weigh, d_bias = act.T @ error, float(error.sum())
            d_act = error[:, None] * model.weigh * (pooled > 0)
            d_filters = [np.zeros_like(f) for f in model.filters]
            spot, grad = [], []
            row_of = np.full(len(vectors), -1)  # vector place -> word
            row_of[np.arange(len(part)) + np.repeat(np.arange(len(sizes)), sizes) * (max(WIDTHS) - 1)] = np.arange(len(part))
            for w, width in enumerate(WIDTHS):
                for j in range(FILTERS):
                    c = w * FILTERS + j
                    for k in range(width):
                        place = np.minimum(top[:, c] + k, len(vectors) - 1)
                        d_filters[w][k, :, j] = vectors[place].T @ d_act[:, c]
                        word = row_of[place]
                        real = (word >= 0) & (d_act[:, c] != 0)
                        spot.append(word[real])
                        grad.append(d_act[real, c][:, None] * model.filters[w][k, :, j])
            spot, grad = np.concatenate(spot), np.concatenate(grad)
            touched = part[spot].reshape(-1)
            keys, inverse = np.unique(touched, return_inverse=True)
            d_table = np.zeros((len(keys), DIM), np.float32)
            np.add.at(d_table, inverse, np.repeat(grad, part.shape[1], axis=0))
            sums[0][keys] += d_table ** 2
            model.table[keys] -= rate * d_table / np.sqrt(sums[0][keys])
            for p, g, s in zip((*model.filters, model.shift, model.weigh),
                               (*d_filters, d_act.sum(axis=0), d_weigh), sums[1:]):
                s += g ** 2
                p -= (rate * g / np.sqrt(s)).astype(np.float32)
            bias_sum += d_bias ** 2
            model.bias -= rate * d_bias / bias_sum ** 0.5
    _learn_languages(model, rows, counts, languages)
    _calibrate(model, *some(np.flatnonzero(held) if held.any() else learn), y[held] if held.any() else y[learn])
    return model


def _learn_languages(model: Model, rows: np.ndarray, counts: np.ndarray, languages: list[str | None]) -> None:
    model.languages = sorted({x for x in languages if x is not None}) or [""]
    index = {x: k for k, x in enumerate(model.languages)}
    of_doc = np.array([index.get(x, -1) for x in languages], int)
    of_word = np.repeat(of_doc, counts)
    seen = np.stack([np.bincount(rows[of_word == k, 0], minlength=ROWS) for k in range(len(model.languages))], axis=1)
    model.language_table = (np.log(seen + 0.5) - np.log(seen.sum(axis=0) + 0.5 * ROWS)).astype(np.float32)
    model.language_table -= model.language_table.mean(axis=1, keepdims=True)


def _calibrate(model: Model, rows: np.ndarray, counts: np.ndarray, y: np.ndarray) -> None:
    """For each language the middle of the gap that gives the best F1; few examples lean on all languages."""
    model.thresholds = np.full(len(model.languages), 0.5)
    if not len(y):
        return
    raw, lang = raw_scores(model, rows, counts), language_of(model, rows, counts)

    def best(s, t):
        order = np.argsort(-s, kind="stable")
        s, t = s[order], t[order]
        f1 = 2 * np.cumsum(t) / (np.arange(1, len(t) + 1) + max(1.0, t.sum()))
        f1[:-1][s[:-1] == s[1:]] = -1
        k = int(f1.argmax())
        return (s[k] + (s[k + 1] if k + 1 < len(s) else 0)) / 2

    common = best(raw, y) if 0 < y.sum() < len(y) else 0.5
    for k in range(len(model.languages)):
        own = lang == k
        yes = y[own].sum()
        model.thresholds[k] = best(raw[own], y[own]) if yes >= 10 and own.sum() - yes >= 10 else common
    model.thresholds = np.clip(model.thresholds, 0.02, 0.98)


def _spread(key: str) -> Column:
    return F.pmod(F.xxhash64(F.lit(3), F.col(key).cast("string")), F.lit(1 << 20))


def _marks(labels: DataFrame, key: str, label: str) -> DataFrame:
    return labels.select(F.col(key).alias("_key"), F.col(label).alias("_label")).where(F.col("_label").isin(0, 1))


def best_thresholds(scored: DataFrame) -> dict[int, tuple[float, int, int]]:
    """(threshold, texts of label 1, of label 0) per ``language`` of ``scored`` (language, score, label), and of all under
    -1: the middle of the gap that gives the best F1, the highest of equal ones. Scores are counted and summed up in
    ranges, so no task gets a whole language."""
    counts = (scored.select(F.explode(F.array("language", F.lit(-1))).alias("language"), "score", "label")
              .groupBy("language", "score").agg(F.sum("label").alias("yes"), F.count(F.lit(1)).alias("n")))
    with scratch(counts, "toxicity-scores") as counts:
        totals = {"yes": F.col("yes"), "n": F.col("n")}
        f1 = 2 * F.col("yes_run") / (F.col("n_run") + F.greatest(F.lit(1), F.col("yes_all")))
        best = running_totals(counts, "score", totals, ["language"], descending=True).groupBy("language").agg(
            F.max(F.struct(f1.alias("f1"), F.col("score").alias("at"))).alias("best"),
            F.max("yes_all").alias("yes"), F.max("n_all").alias("n"))
        below = counts.select("language", "score").join(F.broadcast(best), "language").groupBy("language", "best.at", "yes", "n").agg(
            F.coalesce(F.max(F.when(F.col("score") < F.col("best.at"), F.col("score"))), F.lit(0.0)).alias("next"))
        return {r["language"]: ((r["at"] + r["next"]) / 2, r["yes"], r["n"] - r["yes"]) for r in below.collect()}


def calibrate(model: Model, docs: DataFrame, marks: DataFrame, text: str, key: str) -> None:
    """Set the thresholds of ``model`` from every labelled text of the fifth that ``train`` does not learn from. Few
    examples of a language lean on all languages."""
    import pyarrow as pa

    small_batches(docs.sparkSession)
    fifth = docs.select(F.col(key).alias("_key"), F.col(text).alias("text")).where(_spread("_key") % 5 == 4)
    taken, schema, place = arrow_input(fifth, ("_key",), "text")
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def raw(batches):
        own, hasher = Model(**shared.value), WordHasher(SEPARATORS)
        for batch in batches:
            rows, counts = hashed_words(*lowered(batch.column(place).to_pylist()), hasher)
            yield arrow_output(batch, 1, [pa.array(language_of(own, rows, counts).astype(np.int32), pa.int32()),
                                          pa.array(raw_scores(own, rows, counts).astype(np.float64), pa.float64())])

    scored = taken.mapInArrow(raw, schema + "p0 int, p1 double").toDF("_key", "language", "score")
    found = best_thresholds(scored.join(marks.distinct(), "_key").select("language", "score", F.col("_label").cast("int").alias("label")))
    shared.unpersist()
    if -1 not in found:
        return
    middle, yes, no = found[-1]
    common = middle if yes and no else 0.5
    model.thresholds = np.clip([found[k][0] if k in found and min(found[k][1:]) >= 10 else common
                                for k in range(len(model.languages))], 0.02, 0.98)


def training_rows(docs: DataFrame, labels: DataFrame, per_class: int, text: str, lang: str, key: str, label: str):
    """A bounded, hash-chosen sample (spread, key, label, lang, text) of labelled texts: about 1.2 times ``per_class`` of
    either label, of texts longer than 20,000 characters a window of that length from a place that the hash picks. In
    order of the hash, in one partition."""
    marks = _marks(labels, key, label)
    counts = {r["_label"]: r["count"] for r in marks.groupBy("_label").count().collect()}
    limit = F.create_map(*[x for k, n in counts.items() for x in (
        F.lit(k), F.lit(min(1 << 20, int(1.2 * per_class * (1 << 20) / n) + 64)))]) if counts else F.create_map(F.lit(0), F.lit(0))
    chosen = marks.withColumn("_spread", _spread("_key")).where(F.col("_spread") < limit[F.col("_label")]).distinct()
    chosen = chosen.orderBy("_spread", "_key", "_label").limit(4 * per_class)  # a bound; about 2.4 * per_class are chosen
    n = F.length(text)
    start = F.when(n > 20000, F.pmod(F.xxhash64(F.lit(1), "_key"), n - 19999)).otherwise(0) + 1
    return (docs.select(F.col(key).alias("_key"), F.col(lang).alias("lang"), F.col(text).alias("text"))
            .join(F.broadcast(chosen), "_key").select(
                "_spread", "_key", "_label", "lang", F.substring("text", start.cast("int"), F.lit(20000)).alias("text"))
            .orderBy("_spread", "_key", "_label", "text").limit(4 * per_class))


def train(docs: DataFrame, labels: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
          label: str = "toxic", per_class: int = 2000, **settings) -> Model | None:
    """Fit on the rows of ``docs`` that ``labels`` marks 0 or 1 (other values and null count as no label), in a task;
    None without any such row. The weights come from a sample of ``per_class`` texts of either label, the thresholds
    from all texts of the fifth that is left out (fewer than 50 texts: from those learnt)."""
    def learn(rows):
        taken, out = {0: 0, 1: 0}, []
        for spread, _, mark, language, body in rows:
            if taken[mark] < per_class:
                taken[mark] += 1
                out.append((body or "", mark, language, spread % 5 == 4))
        *rest, held = map(list, zip(*out))
        return vars(fit(*rest, held=held, **settings)), len(out)

    found = fit_in_task(training_rows(docs, labels, per_class, text, lang, key, label), learn)
    if not found:
        return None
    model = Model(**found[0])
    if found[1] >= 50:
        calibrate(model, docs, _marks(labels, key, label), text, key)
    return model


def predict(docs: DataFrame, model: Model | None, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
            names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """``keep`` columns, score (0 to 1) and predicted (1 if score >= 0.5) of every whole text.

    Null counts as empty; texts without words get the score of no filter answering; without a model every
    score is 0. Repeated rows get equal scores, an empty table gives no rows, other columns are not read,
    and ``names`` renames the added columns should they clash.
    """
    import pyarrow as pa

    small_batches(docs.sparkSession)
    taken, schema, place = arrow_input(docs, keep, text)
    shared = docs.sparkSession.sparkContext.broadcast(vars(model) if model else None)

    def label(batches):
        own, hasher = shared.value and Model(**shared.value), WordHasher(SEPARATORS)
        for batch in batches:
            texts = batch.column(place)
            found = np.zeros(len(texts))
            if own is not None and len(texts):
                found = np.clip(scores(own, *hashed_words(*lowered(texts.to_pylist()), hasher)), 0, 1)
            yield arrow_output(batch, len(keep), [pa.array(found, pa.float64()),
                                                  pa.array((found >= 0.5).astype(np.int32), pa.int32())])

    return taken.mapInArrow(label, schema + "p0 double, p1 int").toDF(*keep, *names)
