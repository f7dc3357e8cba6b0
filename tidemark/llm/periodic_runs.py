"""Periodic runs of words, found by an online sparse diagonal DP.

Reading the words of a text one after another, an earlier occurrence of the present word at distance ``lag``
makes the match on diagonal ``lag`` one longer; a diagonal that is not continued has ended, and if it was long
enough it is a run and is given out at once.

Taken literally, a word that fills a text has as many earlier occurrences as there are words, and the work is
quadratic. A run of period q is at least 4q words long, so two facts keep the DP sparse without losing a run:

* Lags are handled in classes [2**k, 2**(k+1)). In a run of that class, word i and the 3 * 2**k - 1 words after
  it equal those ``lag`` words before. So an occurrence counts only if that whole stretch (the *tuple* of i)
  occurs again: tuples that occur once open no diagonal, and longer tuples are made of repeated shorter ones.
* Only the latest earlier occurrence of a tuple can lie on the diagonal of a run. Were a tuple of a run of
  smallest period q to occur at a lag p < q too, it would have the periods p and q; as p + q <= 3 * 2**k + gcd
  or the two lags differ by less than 2**k, a proper divisor of q would be a period of the tuple and, the tuple
  being longer than q, of the run.

So every position has at most one active diagonal in a class, and a text of n words takes O(n log n) steps.
Rows are independent: nothing is shuffled, a lost task is simply run again.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import arrow_input, arrow_output, small_batches, text_buffers

#: A run has at least so many words, and at least so many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
NAMES = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def word_ids(words: list[bytes]) -> np.ndarray:
    """A number for each word; equal words have equal numbers."""
    known = {w: i for i, w in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(known.__getitem__, words), np.int64, len(words))


def _latest(codes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of positions ``at`` (ascending) with tuples ``codes``: those whose tuple repeats, their tuples numbered anew,
    and the distance to the latest earlier occurrence (0: none)."""
    order = np.argsort(codes, kind="stable")
    ranked = codes[order]
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = ranked[1:] == ranked[:-1]
    lag = np.zeros(len(order), np.int64)
    again = np.flatnonzero(same[:-1])
    lag[order[again]] = at[order[again]] - at[order[again - 1]]
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(~same[:-1]) - 1
    repeats = np.zeros(len(order), bool)
    repeats[order] = same[:-1] | same[1:]
    return at[repeats], number[repeats], lag[repeats]


def _diagonals(at: list[int], lags: list[int], low: int, tuple_words: int, found: list) -> None:
    """The DP over the tuple matches of one lag class: extend the active diagonal or end it and give out its run."""
    lag, begin, last = 0, 0, -2
    for i, d in zip(at, lags):
        if d == lag and i == last + 1:
            last = i
            continue
        if lag:
            _emit(begin, last, lag, tuple_words, found)
        lag = d if low <= d < 2 * low else 0
        begin = last = i
    if lag:
        _emit(begin, last, lag, tuple_words, found)


def _emit(begin: int, last: int, lag: int, tuple_words: int, found: list) -> None:
    length = last - begin + tuple_words + lag
    if length >= max(LEAST_WORDS, LEAST_PERIODS * lag):
        found.append((begin - lag, length, lag))


def find_runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    n, found = len(ids), []
    if n < LEAST_WORDS:
        return found
    at, codes, _ = _latest(ids, np.arange(n))
    low, size = 1, 1
    while len(at) and LEAST_PERIODS * low <= n:
        width = 3 * low  # words in a tuple of this class; size: words in the tuples so far
        while size < width:
            step = min(size, width - size)  # a tuple of size + step words is two overlapping shorter ones
            full = np.full(n + 1, -1, np.int64)
            full[at] = codes
            other = full[np.minimum(at + step, n)]
            both = other >= 0
            at, codes, lags = _latest(codes[both] * (int(codes.max(initial=0)) + 1) + other[both], at[both])
            size += step
            if not len(at):
                return sorted(found, key=lambda r: (r[0], r[2]))
        _diagonals(at.tolist(), lags.tolist(), low, width, found)
        low *= 2
    return sorted(found, key=lambda r: (r[0], r[2]))


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period, compared exactly; ties: smallest start, then period."""
    best = None
    for run in runs:  # they come by start, then period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def without_repeats(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stay: those that no run contains after its first period."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:-1]) == 0


def collapse_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", rewrite=None,
                  keep_text: str | None = None, names: tuple[str, ...] = NAMES) -> DataFrame:
    """Per row of ``docs``: the key, the number of periodic runs of its text, the strongest one, and digests of all
    runs and of the text with every run cut to its first period.

    Words are the longest stretches without ASCII white space; nothing else is changed, so the comparison is by
    bytes. A null or blank text has no words: no run, four nulls, digests of the empty string. Rows that repeat,
    or that repeat a key, are each answered; a null key stays null. Other columns are not read. An empty table
    gives no rows. A text of any length is one row of work, linear in its words but for a logarithm.

    ``rewrite(key, words)`` may change the list of words before the search; ``keep_text`` names one more column
    that holds the collapsed text itself.
    """
    import pyarrow as pa

    small_batches(docs.sparkSession)
    taken, kinds, place = arrow_input(docs, (key,), text)
    split = docs.schema[key].dataType.simpleString()

    def make(batches):
        for batch in batches:
            data, at = text_buffers(batch.column(place))
            data, columns = data.tobytes(), [[] for _ in range(8)]
            for k, begin, end in zip(batch.column(0).to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                words = data[begin:end].split()  # of bytes: at ASCII white space only
                if rewrite is not None:
                    words = rewrite(k, words)
                runs = find_runs(word_ids(words))
                start, length, period = strongest(runs) or (None, None, None)
                stays = b" ".join(compress(words, without_repeats(len(words), runs).tolist()) if runs else words)
                listed = "".join(f"{s},{m},{p}\n" for s, m, p in runs)
                row = (len(runs), start, length, period, None if start is None else 1000 * length // period,
                       hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(stays).hexdigest(),
                       stays if keep_text else None)
                for column, value in zip(columns, row):
                    column.append(value)
            added = [pa.array(c, pa.int64()) for c in columns[:5]] + [pa.array(c, pa.string()) for c in columns[5:7]]
            if keep_text:
                added.append(pa.array(columns[7], pa.binary()).cast(pa.string()))
            yield arrow_output(batch, 1, added)

    shape = f"k0 {split}, p0 long, p1 long, p2 long, p3 long, p4 long, p5 string, p6 string" + ", p7 string" * bool(keep_text)
    out = taken.mapInArrow(make, shape)
    wanted = [*names, keep_text] if keep_text else names
    return out.select(F.col("k0").alias(key), *[F.col(f"p{i}").alias(name) for i, name in enumerate(wanted)])


def planted_run(key, words: list[bytes]) -> list[bytes]:
    """For one key in ten (by the crc32 of its decimal form; a null key counts as the empty text) the words from a
    place on are replaced by a repetition of the first few of them."""
    import zlib

    h, n = zlib.crc32(b"" if key is None else str(key).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    once = words[a:a + p]
    return words[:a] + (once * ((n - a) // p + 1))[:n - a]
