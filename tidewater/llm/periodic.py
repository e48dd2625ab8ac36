"""Periodic runs of words, found by seeds that are extended along diagonals.

A run is a stretch of consecutive words with smallest period q, at least
``min_words`` words and ``min_power`` periods long, that no neighbouring word
extends. Words that lie q apart in a run agree over ``max(min_words - q,
(min_power - 1) * q)`` places, at least ``seed`` of them, so the ``seed``-grams of
a text are indexed, and a pair of places with one gram at a distance (a lag) of q
is a seed of the diagonal q. A seed is extended to both sides while the words
agree; a table of the furthest place covered on each lag keeps the run's other
seeds from being extended again.

Pairs are not enumerated all against all, which a text of one repeated word would
make quadratic. Grams as long as the lag or longer are used: the first index, of
``seed``-grams, serves lags up to ``seed``, and indexes of grams twice as long
serve lags twice as large. If a k-gram occurs at i and i + q, q being the run's
smallest period and not above k, it occurs nowhere between: an occurrence at
i + r would give this stretch the periods r and q over r + k >= r + q words, and
so the run a period of gcd(r, q) < q. So the next occurrence of each gram is the
only one to look at, and each seed that is found lies on a run of smallest period
q. There are at most as many pairs as words for each doubling of the lag.

Defined results: null and empty texts have no words and no runs; each repeated
row gets a row; an empty table gives an empty result. Texts are worked on one at
a time, so a very long one needs memory for its own words only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_WORDS, MIN_POWER = 24, 3
RUN = "struct<start: long, length: long, period: long>"


def seed_length(min_words: int = MIN_WORDS, min_power: int = MIN_POWER) -> int:
    """The least overlap that a run of any period guarantees."""
    return min(max(min_words - q, (min_power - 1) * q) for q in range(1, min_words + 1))


def _paired(names: np.ndarray, apart: int) -> np.ndarray:
    """Names of the grams that consist of two named ones, ``apart`` places apart."""
    left, right = names[: len(names) - apart], names[apart:]
    return pd.factorize(left.astype(np.int64) * (int(names.max()) + 1) + right)[0]


def _grams(ids: np.ndarray, length: int) -> np.ndarray:
    """A name for the gram of ``length`` words at each place; equal names, equal
    grams. Empty if no gram occurs twice."""
    names, size = ids, 1
    while size < length:
        apart = min(size, length - size)
        if len(names) <= apart:
            return names[:0]
        names, size = _paired(names, apart), size + apart
        if names.max() + 1 == len(names):  # no gram of this size occurs twice, so no longer one does
            return names[:0]
    return names


def _seeds(names: np.ndarray, above: int, upto: int) -> tuple[np.ndarray, np.ndarray]:
    """Places whose gram next occurs ``above`` < lag <= ``upto`` places on, as
    (place, lag), by lag and place; of places in a row with one lag the first."""
    order = np.argsort(names, kind="stable")
    at, then = order[:-1], order[1:]
    lag = then - at
    use = (names[at] == names[then]) & (lag > above) & (lag <= upto)
    at, lag = at[use], lag[use]
    by = np.lexsort((at, lag))
    at, lag = at[by], lag[by]
    first = np.ones(len(at), dtype=bool)
    first[1:] = (lag[1:] != lag[:-1]) | (at[1:] != at[:-1] + 1)
    return at[first], lag[first]


def _agreeing(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading elements of ``a`` and ``b`` agree."""
    done, step = 0, 64
    end = min(len(a), len(b))
    while done < end:
        differ = np.flatnonzero(a[done : done + step][: end - done] != b[done : done + step][: end - done])
        if len(differ):
            return done + int(differ[0])
        done, step = done + step, step * 2
    return end


def runs(ids: np.ndarray, min_words: int = MIN_WORDS, min_power: int = MIN_POWER) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of the sequence, by start and period.
    ``min_power`` is at least 3."""
    n, size = len(ids), seed_length(min_words, min_power)
    names, found, above = _grams(ids, size) if n >= min_words else ids[:0], [], 0
    while len(names):
        covered: dict[int, int] = {}
        for at, lag in zip(*(x.tolist() for x in _seeds(names, above, size)), strict=True):
            if at < covered.get(lag, 0):
                continue
            end = at + size + _agreeing(ids[at + size : n - lag], ids[at + size + lag :])
            start = at - _agreeing(ids[:at][::-1], ids[lag : at + lag][::-1])
            covered[lag] = end
            length = end - start + lag
            if length >= max(min_words, min_power * lag):
                found.append((start, length, lag))
        above, apart = size, size
        if len(names) <= apart or names.max() + 1 == len(names):
            break
        names, size = _paired(names, apart), size * 2
    return sorted(found, key=lambda r: (r[0], r[2]))


def kept_words(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words stay: those that no run holds after its first period."""
    change = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


def collapse(text: str | None, min_words: int = MIN_WORDS, min_power: int = MIN_POWER) -> tuple[int, list, str]:
    """Number of words, runs, and the words that stay, joined by one space."""
    words = (text or "").encode().split()  # of bytes: splits at ASCII white space only
    if not words:
        return 0, [], ""
    spelled = np.empty(len(words), dtype=object)
    spelled[:] = words
    found = runs(pd.factorize(spelled)[0], min_words, min_power)
    if found:
        words = spelled[kept_words(len(words), found)].tolist()
    return len(spelled), found, b" ".join(words).decode()


def collapse_runs(docs: DataFrame, min_words: int = MIN_WORDS, min_power: int = MIN_POWER) -> DataFrame:
    """doc_id, n_words, runs (start, length and period in words, by start and
    period) and ``text`` without the words that a run repeats. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        struct = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):  # bounds what is held besides the batch
                part = batch.slice(at, 256)
                n, found, text = zip(*(collapse(t.as_py(), min_words, min_power) for t in part.column("text")), strict=True)
                spans = [[{"start": s, "length": m, "period": q} for s, m, q in rs] for rs in found]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(spans, struct), pa.array(text, pa.string())],
                    ["doc_id", "n_words", "runs", "text"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, f"doc_id long, n_words long, runs array<{RUN}>, text string")
