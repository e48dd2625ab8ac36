"""Runs against a comparison of all lags, and the query against plain Python."""

from __future__ import annotations

import hashlib
import random
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewater.llm import periodic, queries

SF = "/root/testdata/sf0.001"


def plain_runs(words, least=24, power=3):
    """Every maximal stretch of period q for all q, unless a divisor of q is one."""
    n, out = len(words), []
    for q in range(1, n // power + 1):
        same = [words[i] == words[i + q] for i in range(n - q)] + [False]
        start = None
        for i, s in enumerate(same):
            if s and start is None:
                start = i
            elif not s and start is not None:
                length = i - start + q
                part = words[start : start + length]
                smaller = any(q % d == 0 and all(part[k] == part[k + d] for k in range(length - d)) for d in range(1, q))
                if length >= max(least, power * q) and not smaller:
                    out.append((start, length, q))
                start = None
    return sorted(out, key=lambda r: (r[0], r[2]))


def ids(words):
    names = {}
    return np.array([names.setdefault(w, len(names)) for w in words], dtype=np.int64)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 4), st.integers(0, 30), st.integers(1, 6)), max_size=8), st.integers(0, 2**30))
def test_runs_match_brute_force(blocks, seed):
    rng = random.Random(seed)
    words = []
    for letters, length, times in blocks:
        words += [rng.randrange(letters) for _ in range(length)] * times
    assert periodic.runs(ids(words)) == plain_runs(words)


def test_runs_within_runs_and_at_the_bounds():
    inner = ["x"] * 30 + ["y"]
    words = inner * 3 + list("abcdefgh") * 3 + ["end"] + list("abcdefgh") * 2 + list("abcdefg") + list(map(str, range(40))) * 3
    want = plain_runs(words)
    assert periodic.runs(ids(words)) == want
    assert {q for *_, q in want} >= {1, 31, 8, 40}
    assert periodic.runs(ids(["a"] * 23)) == [] and periodic.runs(ids(["a"] * 24)) == [(0, 24, 1)]
    assert periodic.runs(ids([*map(str, range(9))] * 3)) == [(0, 27, 9)] and periodic.runs(ids([*map(str, range(9))] * 3)[:-1]) == []


@pytest.mark.parametrize("least, power", [(6, 3), (10, 4), (40, 3), (25, 5)])
def test_other_bounds(least, power):
    rng = random.Random(least)
    words = []
    for _ in range(12):
        words += [rng.randrange(3) for _ in range(rng.randrange(1, 12))] * rng.randrange(1, 8)
    assert periodic.runs(ids(words), least, power) == plain_runs(words, least, power)


def test_long_hostile_texts_take_near_linear_time():
    rng = random.Random(5)
    fib = [[0], [0, 1]]
    while len(fib[-1]) < 150_000:
        fib.append(fib[-1] + fib[-2])
    texts = {
        "one word": [7] * 200_000, "two words": [1, 2] * 100_000, "Fibonacci": fib[-1],
        "many short runs": [w for i in range(6_000) for w in [0] * 30 + [i + 1]],
        "one long period": [rng.randrange(9) for _ in range(60_000)] * 3, "few letters": [rng.randrange(2) for _ in range(200_000)],
    }
    for name, words in texts.items():
        t = time.process_time()
        found = periodic.runs(np.array(words, dtype=np.int64))
        assert time.process_time() - t < 20, name
        if name == "one word":
            assert found == [(0, 200_000, 1)]
        if name == "many short runs":
            assert len(found) == 6_000
        if name == "one long period":
            assert (0, 180_000, 60_000) in found


def altered(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]


def answer(doc_id, text):
    words = altered(doc_id, [w.decode() for w in (text or "").encode().split()])
    found = plain_runs(words)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        sha("".join(f"{s},{m},{q}\n" for s, m, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def rows(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in frame.collect()), key=str)


def test_query_matches_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = sorted((answer(i, t) for i, t in docs if len((t or "").split()) < 900), key=str)
    ids_ = {w[0] for w in want}
    got = [r for r in rows(queries.op12_periodic_runs(spark, SF)) if r[0] in ids_]
    assert got == want and len(rows(queries.op12_periodic_runs(spark, SF))) == len(docs)
    assert sum(w[1] > 0 for w in want) > 5


def test_nulls_ties_repeats_and_clashing_columns(spark, tmp_path):
    multiples = [i for i in range(300) if zlib.crc32(str(i).encode()) % 10 == 0][:6]
    two = "p q " * 12 + "stop " + "r s " * 12  # equal exponents: the smaller start counts
    texts = [None, "", " \n\t\x0b ", two, "a " * 30, "x y " * 30, "one", "one two", "é\u0085 " * 25]
    docs = [(i, t) for i in multiples for t in texts] + [(None, two), (None, two), (multiples[0], two), (None, None), (1, two)]
    table = spark.createDataFrame([(*d, 5, "x") for d in docs], "doc_id long, text string, runs int, n_words string")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    assert rows(queries.op12_periodic_runs(spark, str(tmp_path))) == sorted((answer(*d) for d in docs), key=str)
    table.limit(0).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert rows(queries.op12_periodic_runs(spark, str(tmp_path))) == []


def test_collapse_keeps_one_period_of_each_run(spark):
    n, found, text = periodic.collapse("start " + "la la li " * 20 + "end")
    assert (n, text) == (62, "start la la li end") and found == [(1, 60, 3)]
