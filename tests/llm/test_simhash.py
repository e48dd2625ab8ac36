"""SimHash linking and components against brute force."""

from __future__ import annotations

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from tidewater.llm import components, queries, simhash

SF = "/root/testdata/sf0.001"


def fp(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(values, bits=3):
    """values: (id, fingerprint) -> component of each row."""
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i][1] ^ values[j][1]).bit_count() <= bits:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(values):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [least.get(find(i)) for i in range(len(values))]


TEXTS = [
    None, "", "  \n", "one", "One\ttwo", "a b c", "a b c d " * 30, "ÉTÉ au Lac Été", "été au lac été", "x y z w",
    " ".join(f"w{i % 811}" for i in range(90_000)), "same text here", "same text here", "SAME text\nhere",
]


def test_rows_match_brute_force(spark):
    rows = [*enumerate(TEXTS), (None, "nobody owns this text"), (None, "same text here"), (3, "one")]
    got = simhash.near_duplicates(spark.createDataFrame([(*r, 1, "b") for r in rows], "doc_id long, text string, fp long, label string"))
    got = sorted(((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in got.collect()), key=str)
    values = [(d, fp(t)) for d, t in rows]
    assert got == sorted(((d, f, c) for (d, f), c in zip(values, brute(values), strict=True)), key=str)


@pytest.mark.parametrize("segments", [2, 3, 4])
def test_links_find_every_pair(spark, segments):
    rng = random.Random(segments)
    base = [rng.getrandbits(64) for _ in range(40)]
    some = set(base) | {0, 1, 2**64 - 1}
    for b in base * 4:
        for _ in range(rng.randint(1, 4)):
            b ^= 1 << rng.randrange(64)
        some.add(b)
    signed = [x - 2**64 if x >> 63 else x for x in some]
    got = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), 3, segments).collect()
    pairs = {frozenset(p) for p in got}
    assert len(pairs) == len(got)
    assert pairs == {frozenset((a, b)) for a in signed for b in signed if a < b and ((a ^ b) % 2**64).bit_count() <= 3}


def test_components_of_chains_stars_and_cycles(spark):
    chain = [(i, i + 1) for i in range(100, 180)]
    star = [(5, i) for i in range(1000, 1400)]
    ring = [(i, (i + 1) % 7 - 50) for i in range(-50, -44)] + [(-44, -50)]
    rows = chain + [(b, a) for a, b in star] + ring + [(7, 7), (1, 2), (2, 1)]
    got = {r["vertex"]: r["label"] for r in components.connected_components(spark.createDataFrame(rows, "u long, v long")).collect()}
    assert all(got[v] == 100 for v in range(100, 181)) and all(got[v] == 5 for _, v in star)
    assert got[1] == got[2] == 1 and 7 not in got
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_query_matches_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    values = [(r["doc_id"], fp(r["text"])) for r in rows]
    want = {(d, f"{f:016x}", c) for (d, f), c in zip(values, brute(values), strict=True)}
    got = queries.op5_simhash_near_dedup(spark, SF)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert {tuple(r) for r in got.collect()} == want


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).agg(F.count(F.lit(1))).first()[0] == 0
