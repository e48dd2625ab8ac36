"""Greedy string tiling against a brute-force version."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from tidewater.llm import queries, tiling

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[0-9a-z\x80-\U0010ffff]+")


def brute_tiles(doc, item, least):
    used_d, used_i, out = set(), set(), []
    while True:
        best = None
        for p in range(len(doc)):
            for q in range(len(item)):
                n = 0
                while p + n < len(doc) and q + n < len(item) and doc[p + n] == item[q + n] and p + n not in used_d and q + n not in used_i:
                    n += 1
                if n >= least and (best is None or n > best[2]):
                    best = (p, q, n)
        if best is None:
            return out
        out.append(best)
        used_d.update(range(best[0], best[0] + best[2]))
        used_i.update(range(best[1], best[1] + best[2]))


@pytest.mark.parametrize("seed", range(25))
def test_tiles_match_brute_force(seed):
    rng = random.Random(seed)
    letters = "ab" if seed % 2 else "abcdefgh"
    item = [rng.choice(letters) for _ in range(rng.randint(1, 25))]
    doc = [rng.choice(letters) for _ in range(rng.randint(1, 40))] + item[8:] + item[:8]
    least = rng.randint(1, 5)
    seeds = [(p, q) for p in range(len(doc) - least + 1) for q in range(len(item) - least + 1) if doc[p : p + least] == item[q : q + least]]
    assert tiling.tiles(seeds, least) == brute_tiles(doc, item, least)


def brute(docs, items, least=5, share=0.5):
    out = set()
    for i, t in items:
        item = WORD.findall((t or "").lower())
        for d, text in docs:
            doc = WORD.findall((text or "").lower())
            found = brute_tiles(doc, item, least) if set(doc) & set(item) else []
            covered = sum(n for _, _, n in found)
            if item and covered and covered >= share * len(item):
                out.add((d, i, len(item), len(found), covered))
    return out


def pairs(spark, docs, items):
    d = spark.createDataFrame([(*r, 0, "w") for r in docs], "doc_id long, text string, seed int, words string")
    i = spark.createDataFrame([(*r, 9) for r in items], "item_id long, text string, pos int")
    got = tiling.contaminated(d.repartition(3), i)
    return [(r["doc_id"], r["item_id"], r["n_item_words"], r["n_tiles"], r["n_covered"]) for r in got.collect()]


def test_reordered_passages_nulls_ties_and_repeats(spark):
    item = " ".join(f"Term{i}" for i in range(30))
    w = item.split()
    turned = " ".join(w[20:] + ["between"] + w[10:20] + ["ÉTÉ."] + w[:10])
    docs = [
        (1, item), (1, item), (2, f"lead in {turned} and out"), (3, " ".join(w[:10])), (4, None), (5, ""), (None, turned),
        (6, " ".join(w[:16]).upper()), (7, "term0, term1!\nterm2 term3" * 30), (8, "filler " * 30_000 + item), (9, " ".join(w[::2])),
        (10, "été " * 6 + "x"), (11, "\x00 a\x00b"),
    ]
    items = [(1, item), (2, item), (None, turned), (3, None), (4, "too short"), (5, "ÉTÉ été Été été été y")]
    got = pairs(spark, docs, items)
    assert len(got) == len(set(got)) and set(got) == brute([(d, t if d != 8 else item) for d, t in docs], items)
    assert {(2, 1), (None, 1), (6, 1), (8, 1)} <= {x[:2] for x in got} and not {3, 4, 5, 7, 9} & {x[0] for x in got}


def test_empty_tables(spark):
    assert pairs(spark, [], [(1, "a b c d e f")]) == []
    assert pairs(spark, [(1, "a b c d e f")], []) == []


def quick_tiles(doc, item, least):
    """The same greedy tiling by tables of common run lengths, remade after each
    tile from the words that are not marked."""
    names = {w: k for k, w in enumerate({*doc, *item})}
    d, i = (np.array([names[w] for w in x]) for x in (doc, item))
    equal, out = d[:, None] == i[None, :], []
    while True:
        runs = np.zeros((len(d) + 1, len(i) + 1), dtype=int)
        for p in range(len(d) - 1, -1, -1):
            runs[p, :-1] = np.where(equal[p], runs[p + 1, 1:] + 1, 0)
        n = runs.max()
        if n < least:
            return out
        p, q = divmod(int(runs.argmax()), len(i) + 1)
        out.append((p, q, int(n)))
        equal[p : p + n, :] = equal[:, q : q + n] = False


@pytest.mark.parametrize("seed", range(8))
def test_quick_tiles_are_the_plain_ones(seed):
    rng = random.Random(seed)
    doc, item = ([rng.choice("abcd") for _ in range(rng.randint(6, 60))] for _ in range(2))
    assert quick_tiles(doc, item, 2) == brute_tiles(doc, item, 2)


def test_query_matches_brute_force(spark):
    """Every document against every item that shares a seed with it."""
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [(i, WORD.findall(t.lower())) for i, t in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    grams = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in items}
    want = set()
    for d, t in docs:
        w = WORD.findall(t.lower())
        have = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
        for i, item in items:
            if grams[i] & have:
                found = quick_tiles(w, item, 5)
                covered = sum(n for *_, n in found)
                if 2 * covered >= len(item):
                    want.add((d, i, len(item), len(found), covered, max(n for *_, n in found)))
    names = ("doc_id", "item_id", "n_item_words", "n_tiles", "n_covered", "longest_tile")
    got = {tuple(r[c] for c in names) for r in queries.op3_benchmark_decontamination(spark, SF).collect()}
    assert got == want and want


def test_a_phrase_that_all_share_makes_no_pairs(spark):
    """Every document and every item hold one phrase of seven words, three seeds of
    items with a least of four; only real copies are candidates."""
    phrase = "once upon a time there was a".split()
    items = [(i, phrase + [f"item{i}w{k}" for k in range(33)]) for i in range(30)]
    docs = [(d, [f"doc{d}w{k}" for k in range(40)] + phrase) for d in range(60)]
    docs += [(100 + i, ["lead", *w[20:], "turned", *w[:20]]) for i, w in items[:5]]
    got = pairs(spark, [(d, " ".join(w)) for d, w in docs], [(i, " ".join(w)) for i, w in items])
    assert {x[:2] for x in got} == {(100 + i, i) for i in range(5)}
    seeds = lambda rows: [(r, r, p, " ".join(w[p : p + 5]), len(w)) for r, w in rows for p in range(len(w) - 4)]
    left = spark.createDataFrame(seeds(docs), "doc_id long, row_key long, pos int, words string, n int").selectExpr("*", "xxhash64(words) AS seed")
    right = spark.createDataFrame(seeds(items), "item_id long, item_key long, at int, item_words string, n_item int").selectExpr("*", "xxhash64(item_words) AS seed")
    found = {(r["doc_id"], r["item_id"]) for r in tiling.candidates(left, right, 5, 0.5).collect()}
    assert found == {(100 + i, i) for i in range(5)}


def test_items_that_share_an_id_are_told_apart(spark):
    one, two = (" ".join(f"{c}{k}" for k in range(20)) for c in "xy")
    got = pairs(spark, [(1, one), (2, two)], [(7, one), (7, two), (7, one), (None, two)])
    assert sorted(got, key=str) == [(1, 7, 20, 1, 20), (2, 7, 20, 1, 20), (2, None, 20, 1, 20)]
