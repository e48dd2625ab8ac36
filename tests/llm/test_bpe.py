"""Merge replay against the public tokenizer library, and exact round trips."""

from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from tidewater.llm import bpe, queries

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SF = "/root/testdata/sf0.001"


def library(ranks):
    return tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def real():
    with open(PATH, "rb") as f:
        return bpe.vocabulary(f.read())


TEXTS = [
    None, "", " ", "\n\n  \n", "a", "aaaaaaaaaaaaaaaa", "don't we'll I'M ''s 's's", "  two  spaces\t\ttabs \r\n", "été Ünïcode 東京 😀😀 ½²",
    "x" * 5000, "\u0085\x1c\x1d    mixed", "<|endoftext|> 123456 7,8.9", "\x00\x01￾\U0010ffff", "abc" * 400 + " " * 300,
]


def encode(texts, v):
    e = bpe.Encoder(v, public_tokenizers.PATTERN)
    ids, counts = e.join(e.learn([t or "" for t in texts]))
    out, at = [], 0
    for c in counts:
        out.append(ids[at : at + c].tolist())
        at += c
    return out


def test_same_ids_as_the_library(real):
    rng = random.Random(1)
    pools = ["ab ", "etaoin shrdlu'\n", [chr(c) for c in range(0x20, 0x3000)], [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]]
    texts = TEXTS + ["".join(rng.choice(rng.choice(pools)) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    lib = library(real.ranks)
    assert encode(texts, real) == [lib.encode_ordinary(t or "") for t in texts]


@pytest.mark.parametrize("seed", range(30))
def test_lower_ranks_that_come_up_late_and_overlaps(seed):
    rng = random.Random(seed)
    tokens = {bytes([x]): x for x in range(256)}
    words = {"".join(rng.choice("abc") for _ in range(rng.randint(2, 5))).encode() for _ in range(25)}
    for rank, w in enumerate(rng.sample(sorted(words), len(words))):
        tokens[w] = 256 + rank
    content = b"\n".join(base64.b64encode(t) + b" " + str(r).encode() for t, r in tokens.items())
    texts = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 40))) for _ in range(200)]
    lib = library(tokens)
    assert encode(texts, bpe.Vocabulary(content)) == [lib.encode_ordinary(t) for t in texts]


def test_piece_table_begins_anew(real, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_PIECES", 3)
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 50)
    monkeypatch.setattr(bpe, "BLOCK", 2)
    e = bpe.Encoder(real, public_tokenizers.PATTERN)
    lib = library(real.ranks)
    for t in TEXTS[4:]:
        ids, _ = e.join(e.learn([t, t]))
        assert ids.tolist() == lib.encode_ordinary(t) * 2


@pytest.mark.parametrize("sizes", [{}, {"block_bytes": 40, "most": 5}])
def test_rows_round_trip(spark, real, sizes):
    rows = [*enumerate(TEXTS), (3, TEXTS[3]), (None, "no id"), (99, None)]
    docs = spark.createDataFrame([(*r, [1], "d", "p") for r in rows], "doc_id long, text string, ids array<int>, decoded string, piece string")
    lib = library(real.ranks)
    got = bpe.decode(bpe.encode(docs.repartition(3), PATH, public_tokenizers.PATTERN, **sizes), PATH).collect()
    want = [(d, lib.encode_ordinary(t or ""), (t or "").encode()) for d, t in rows]
    assert sorted(((r["doc_id"], r["ids"], bytes(r["decoded"])) for r in got), key=str) == sorted(want, key=str)


def test_blocks_and_their_pieces(spark):
    rows = [(i, f"the common start of text {i} " * 3) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    found = [r.asDict() for r in bpe.numbered(docs, public_tokenizers.PATTERN, 4, block_bytes=300).collect()]
    blocks, parts = {}, {}
    for r in (r for r in found if r["part"] is not None):
        numbers = bpe._unpacked(r["numbers"], r["n"]).cumsum().tolist()
        for no, piece in zip(numbers, bpe._words(r), strict=True):
            assert blocks.setdefault(r["block"], {}).setdefault(no, piece) == piece
            assert parts.setdefault(piece, r["part"]) == r["part"]
    assert len(blocks) > 4 and set(parts.values()) == {0, 1, 2, 3}
    assert all(sorted(b) == list(range(len(set(b.values())))) for b in blocks.values())
    texts = [r for r in found if r["part"] is None]
    whole = {r["doc_id"]: b"".join(blocks[r["block"]][x] for x in bpe._unpacked(r["numbers"], r["n"])).decode() for r in texts}
    assert whole == dict(rows)


@pytest.mark.parametrize("bounds", [{}, {"limit": 20, "most": 3}])
def test_pieces_of_many_blocks(spark, real, bounds):
    text = "the same words in all blocks and zq%d of one "
    docs = spark.createDataFrame([(i, text % i * 2) for i in range(40)], "doc_id long, text string").repartition(3)
    with open(PATH, "rb") as f:
        ranks = spark.sparkContext.broadcast(f.read())
    rows = bpe.numbered(docs, public_tokenizers.PATTERN, 5, block_bytes=100).cache()
    pieces = {(r["block"], x): w for r in rows.where("part is not null").collect()
              for x, w in zip(bpe._unpacked(r["numbers"], r["n"]).cumsum().tolist(), bpe._words(r.asDict()), strict=True)}
    lib, seen = library(real.ranks), set()
    for r in bpe.replayed(rows.where("part is not null"), ranks, **bounds).collect():
        counts, ids = bpe._unpacked(r["counts"], r["n"]).tolist(), bpe._unpacked(r["ids"], r["n_ids"]).tolist()
        for x, n in zip(bpe._unpacked(r["numbers"], r["n"]).cumsum().tolist(), counts, strict=True):
            assert ids[:n] == lib.encode_ordinary(pieces[r["block"], x].decode())
            ids = ids[n:]
            seen.add((r["block"], x))
    rows.unpersist()
    assert seen == set(pieces)


def test_documents_stay_in_their_buckets(spark):
    before = {t.name for t in spark.catalog.listTables()}
    encoded = bpe.encode(spark.createDataFrame([(1, "a text")], "doc_id long, text string"), PATH, public_tokenizers.PATTERN)
    plan = encoded._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Bucketed: true" in plan
    assert {t.name for t in spark.catalog.listTables()} == before


@pytest.mark.parametrize("sizes", [{}, {"block_bytes": 40, "most": 5}])
def test_round_trip_is_decode_of_encode(spark, real, monkeypatch, sizes):
    monkeypatch.setattr(bpe, "BLOCK", 3)
    rows = [*enumerate(TEXTS), (3, TEXTS[3]), (None, "no id"), (99, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    lib = library(real.ranks)
    got = bpe.round_trip(docs, PATH, public_tokenizers.PATTERN, **sizes).collect()
    want = [(d, lib.encode_ordinary(t or ""), (t or "").encode()) for d, t in rows]
    assert sorted(((r["doc_id"], r["ids"], bytes(r["decoded"])) for r in got), key=str) == sorted(want, key=str)


def test_block_comes_in_batches(real, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK", 2)
    texts = {"doc_id": [1, None, 3, 4], "n": [3, 0, 1, 2], "numbers": [bpe._packed(np.array(x)) for x in ([0, 1, 0], [], [1], [1, 1])]}
    pieces = [{"n": 2, "numbers": bpe._packed(np.array([0, 1])), "counts": bpe._packed(np.array([2, 1])), "n_ids": 3, "ids": bpe._packed(np.array([70, 71, 72]))}]
    kinds = pa.schema([("doc_id", pa.int64()), ("n", pa.int32()), ("numbers", pa.binary())])
    found = [b.to_pydict() for b in bpe._assembled(pa.table(texts, schema=kinds), pa.Table.from_pylist(pieces))]
    assert found == [{"doc_id": [1], "ids": [[70, 71, 72, 70, 71]]}, {"doc_id": [None, 3, 4], "ids": [[], [72], [72, 72]]}]


def test_one_python_step_beside_the_block(spark, tmp_path):
    spark.createDataFrame([(1, "a text")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    plan = queries.op9_byte_bpe(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("FlatMapCoGroupsInArrow")]
    assert "MapInArrow" not in above and plan.count("Exchange hashpartitioning") == 2


def test_empty_table(spark):
    assert bpe.digests(spark.createDataFrame([], "doc_id long, text string"), PATH, public_tokenizers.PATTERN).count() == 0


def test_query_digests(spark, real):
    lib = library(real.ranks)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = set()
    for d, t in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        ids = lib.encode_ordinary(t)
        want.add((d, len(ids), sha(",".join(map(str, ids)).encode()), sha(t.encode())))
    assert {tuple(r) for r in queries.op9_byte_bpe(spark, SF).collect()} == want
