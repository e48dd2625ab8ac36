"""Repeated strings against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from tidewater.llm import bwt, queries, substrings

SF = "/root/testdata/sf0.001"


def brute(texts, length):
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(t, gone, strict=True) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(t), sum(gone), spans, kept))
    return out


@pytest.mark.parametrize("seed", range(60))
def test_windows_match_brute_force(seed):
    rng = random.Random(seed)
    letters = rng.choice([b"a", b"ab", b"abcd", bytes(range(256)), b"\x00\x01\xff"])
    length = rng.choice([1, 2, 3, 5, 8, 13])
    pool = [bytes(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(5)]
    texts = [b"".join(rng.choice(pool)[: rng.randint(0, 30)] for _ in range(rng.randint(0, 4))) for _ in range(rng.randint(1, 8))]
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    want = [[i for i in range(len(t) - length + 1) if count[t[i : i + length]] > 1] for t in texts]
    assert [x.tolist() for x in bwt.repeated_windows(texts, length)] == want


def test_equal_windows_share_an_anchor(monkeypatch):
    monkeypatch.setattr(substrings, "SEGMENT", 700)
    rng = random.Random(5)
    piece = bytes(rng.choice(b"ab c") for _ in range(300))
    anchor_of = {}
    for _ in range(20):
        data = bytes(rng.choice(b"ab c") for _ in range(rng.randint(0, 900))) + piece + b"aaaa" * rng.randint(0, 150)
        covered = 0
        for start, size, anchor, _ in substrings.runs(data):
            assert start == covered
            covered += size
            for i in range(start, start + size):
                assert anchor_of.setdefault(data[i : i + 200], anchor) == anchor
        assert covered == max(0, len(data) - 199)


def texts():
    rng = random.Random(11)
    words = [f"w{i}é" for i in range(400)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared, page = prose(60), prose(200)
    out = [None, "", "short", "x" * 199, "y" * 200, "z" * 1000, page, page, page[:700] + " Edit " + page[700:], prose(30) + shared + prose(30)]
    out += [shared + prose(5), "tail " + shared, shared[:150], page[100:350], prose(20_000) + shared[20:], "\x00" * 300 + "a", "ab" * 120]
    return out + [prose(50) + "The same boilerplate of a page: " + page[300:480] + prose(50) for _ in range(12)]


def check(spark, rows, hot=substrings.HOT_BYTES):
    docs = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, start int, anchor int").repartition(3)
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in substrings.remove_repeated(docs).collect()]
    want = [(d, *x) for (d, _), x in zip(rows, brute([(t or "").encode() for _, t in rows], 200), strict=True)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_rows_match_brute_force(spark):
    check(spark, [*enumerate(texts()), (6, texts()[6]), (None, "no id " * 60), (2, "short")])


@pytest.mark.parametrize("hot_bytes, levels", [(0, 2), (900, 6)])
def test_anchors_too_large_for_a_block(spark, monkeypatch, hot_bytes, levels):
    """Hot anchors are cut by further orders of k-mers, and counted after the last."""
    monkeypatch.setattr(substrings, "LEVELS", levels)
    counted = []
    real = substrings._by_count
    monkeypatch.setattr(substrings, "_by_count", lambda *a: counted.append(1) or real(*a))
    rows = list(enumerate(texts()[:13] + texts()[15:]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: substrings.merged(r["spans"]) for r in substrings.repeated_ranges(docs, hot_bytes=hot_bytes).collect()}
    want = brute([(t or "").encode() for _, t in rows], 200)
    assert {d: sum(z - a for a, z in spans) for d, spans in got.items()} == {d: n for d, (_, n, _, _) in enumerate(want) if n}
    assert {d: len(spans) for d, spans in got.items()} == {d: k for d, (_, n, k, _) in enumerate(want) if n}
    assert counted or levels > 2


@pytest.mark.parametrize("level", range(1, 5))
def test_equal_windows_share_an_anchor_in_every_order(level):
    rng, anchor_of = random.Random(level), {}
    piece = bytes(rng.choice(b"ab c") for _ in range(320))
    other = 0
    for _ in range(10):
        data = bytes(rng.choice(b"ab c") for _ in range(rng.randint(0, 400))) + piece
        for start, size, anchor, _ in substrings.runs(data, level=level):
            other += anchor not in {a for *_, a, _ in substrings.runs(data)}
            for i in range(start, start + size):
                assert anchor_of.setdefault(data[i : i + 200], anchor) == anchor
    assert other


@pytest.mark.parametrize("rows", [[], [(1, "alone " * 20)]])
def test_empty_and_single(spark, rows):
    check(spark, rows)


def test_query_digest(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    found = brute([r["text"].encode() for r in rows], 200)
    want = {(r["doc_id"], n, k, s, hashlib.sha256(t).hexdigest()) for r, (n, k, s, t) in zip(rows, found, strict=True)}
    assert {tuple(r) for r in queries.op10_suffix_array_dedup(spark, SF).collect()} == want
