"""Benchmark decontamination by greedy string tiling.

Seeds are runs of ``min_match`` words. A fixed-size bitmap of the benchmark's
seed digests, built by Spark, is broadcast to the scan of the documents, so only
positions whose seed may occur in the benchmark leave the scan; an exact join on
the seed digest decides. Of an item's seeds, those that occur most in the documents
are left out of this join as far as no covered item can be missed. The bitmap's size does not depend on the benchmark: a
larger one lets more positions through, but the result stays the same.

Pairs of document and item whose shared seeds cover enough of the item go to the
tiling proper, one pair at a time: the longest common runs that do not overlap
marked words are marked, longest first, until none of at least ``min_match``
words is left. Runs are found Karp-Rabin style, by equal rolling digests of seeds
on one diagonal, and their words are compared before they are marked. As tiles
may lie anywhere in the document, an item whose passages were reordered is
covered like one that was copied straight.

Words are runs of ASCII letters and digits and of non-ASCII characters, in lower
case. Defined results: null and
empty texts and items under ``min_match`` words match nothing; repeated document
rows give one row per item; a null doc_id or item_id is a value like any other, and
items that share an id but not the text are items of their own;
an empty table on either side gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewater.llm.common import row_key, scratch, written

MIN_MATCH, COVERAGE = 5, 0.5
BITS = 24  # the bitmap has 2 ** BITS bits, two megabytes
BASE = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of words: 0-9, a-z and everything outside ASCII.
IN_WORD = np.array([48 <= x <= 57 or 97 <= x <= 122 or x >= 128 for x in range(256)])


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes of all texts, start and end of each word in them, and
    the number of each text's first word (one more than there are texts)."""
    lower = pc.utf8_lower(pc.fill_null(texts, "")).cast(pa.string())
    at = np.frombuffer(lower.buffers()[1], np.int32, len(lower) + 1, lower.offset * 4).astype(np.int64)
    data = np.frombuffer(lower.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
    at -= at[0]
    word = IN_WORD[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[at] = True
    none = np.zeros(1, dtype=bool)
    starts = np.flatnonzero(word & (~np.concatenate([none, word])[:-1] | edge[:-1]))
    ends = np.flatnonzero(word & (~np.concatenate([word, none])[1:] | edge[1:])) + 1
    return data, starts, ends, np.searchsorted(starts, at)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _seeds(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Rolling digest of the ``length`` words from each word on, and whether they
    lie inside one text. The words' digests are polynomials of their bytes."""
    n, sizes = len(starts), ends - starts
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    begin = np.cumsum(sizes) - sizes
    place = np.arange(sizes.sum()) - np.repeat(begin, sizes)
    powers = np.multiply.accumulate(np.full(int(sizes.max()), BASE, dtype=np.uint64))
    code = _mix(np.add.reduceat((data[np.repeat(starts, sizes) + place] + np.uint64(1)) * powers[place], begin))
    rolled = np.zeros(n, dtype=np.uint64)
    for k in range(length):
        rolled *= BASE
        rolled[: max(n - k, 0)] += code[k:]
    last = np.repeat(first[1:], np.diff(first))
    return _mix(rolled), np.arange(n) + length <= last


def _seed_rows(docs: DataFrame, length: int, bitmap: bytes | None) -> DataFrame:
    """doc_id, row_key, pos, seed, and the seed's words, for every seed whose bit
    is set in ``bitmap`` (all seeds if there is none)."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if shared.value is None else np.frombuffer(shared.value, dtype=np.uint8)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                b = batch.slice(at, 1024)
                data, starts, ends, first = _words(b.column("text"))
                seed, good = _seeds(data, starts, ends, first, length)
                if bits is not None:
                    low = (seed & np.uint64((1 << BITS) - 1)).astype(np.int64)
                    good &= (bits[low >> 3] >> (low & 7).astype(np.uint8) & 1).astype(bool)
                place = np.flatnonzero(good)
                row = np.searchsorted(first, place, side="right") - 1
                text = [b" ".join(data[starts[i] : ends[i]].tobytes() for i in range(p, p + length)).decode() for p in place]
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").take(pa.array(row)), b.column("row_key").take(pa.array(row)), pa.array(place - first[row], pa.int32()),
                     pa.array(seed[place].view(np.int64)), pa.array(text, pa.string()), pa.array(np.diff(first)[row], pa.int32())],
                    ["id", "row_key", "pos", "seed", "words", "n"],
                )

    return docs.mapInArrow(run, "id long, row_key long, pos int, seed long, words string, n int")


def _bitmap(seeds: DataFrame) -> bytes:
    """Bit (seed mod 2 ** BITS) set for every seed: pieces of 32768 bits are made
    by Spark, at most 2 ** BITS / 32768 of them reach the driver."""
    slot = F.col("seed").bitwiseAND(F.lit((1 << BITS) - 1))
    pieces = seeds.select(F.shiftright(slot, 15).alias("piece"), slot.bitwiseAND(F.lit(32767)).alias("bit"))
    out = np.zeros(1 << BITS >> 3, dtype=np.uint8)
    for r in pieces.groupBy("piece").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():
        out[r["piece"] * 4096 : r["piece"] * 4096 + 4096] = np.frombuffer(r["bits"], dtype=np.uint8)
    return out.tobytes()


def tiles(matches: list[tuple[int, int]], length: int) -> list[tuple[int, int, int]]:
    """Greedy tiling from seed matches (document position, item position):
    (document start, item start, words) of each tile, in the order of marking."""
    diagonals: dict[int, list[int]] = defaultdict(list)
    for p, q in set(matches):
        diagonals[p - q].append(p)
    runs = []  # (words, document start, item start)
    for d, places in diagonals.items():
        places.sort()
        start = previous = places[0]
        for p in [*places[1:], None]:
            if p != previous + 1 or p is None:
                runs.append((previous - start + length, start, start - d))
                start = p
            previous = p
    by_length: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for n, p, q in runs:
        by_length[n].append((p, q))
    in_doc: set[int] = set()
    in_item: set[int] = set()
    out = []
    for n in range(max(by_length, default=0), length - 1, -1):
        for p, q in sorted(by_length.pop(n, ())):
            free = [p + k not in in_doc and q + k not in in_item for k in range(n)]
            if all(free):
                out.append((p, q, n))
                in_doc.update(range(p, p + n))
                in_item.update(range(q, q + n))
                continue
            k = 0
            while k < n:  # what is unmarked goes on as shorter runs
                end = k
                while end < n and free[end]:
                    end += 1
                if end - k >= length:
                    by_length[end - k].append((p + k, q + k))
                k = end + 1
    return out


def candidates(left: DataFrame, right: DataFrame, min_match: int, coverage: float) -> DataFrame:
    """doc_id, row_key, item_id, item_key: pairs that share one of the item's rarer
    seeds.

    Tiles that cover enough of an item of n words hold the seeds of at least
    t = coverage * n / min_match of its places, as a tile of w words holds
    w - min_match + 1 >= w / min_match of them. So of any places but t - 1, a
    document that covers enough holds one, and the t - 1 places whose seeds most
    document places have are not looked up: a phrase that all documents and items
    share makes no pair by itself.
    """
    frequency = left.groupBy("seed").agg(F.count(F.lit(1)).alias("places"))
    least = F.greatest(F.ceil(F.col("n_item") * coverage / min_match), F.lit(1))
    of_item = W.partitionBy("item_id", "item_key")
    ranked = right.join(frequency, "seed", "left").withColumns({
        "rank": F.row_number().over(of_item.orderBy(F.coalesce("places", F.lit(0)), "at")), "all": F.count(F.lit(1)).over(of_item),
    })
    probes = ranked.where((F.col("rank") <= F.col("all") - least + 1) & F.col("places").isNotNull())
    seeds = left.select("doc_id", "row_key", "seed", "words").distinct()
    found = seeds.join(probes.select("item_id", "item_key", "seed", "item_words").distinct(), "seed")
    return found.where(F.col("words") == F.col("item_words")).select("doc_id", "row_key", "item_id", "item_key").distinct()


def contaminated(
    docs: DataFrame, items: DataFrame, min_match: int = MIN_MATCH, coverage: float = COVERAGE
) -> DataFrame:
    """doc_id, row_key, item_id, n_item_words, n_tiles, n_covered, longest_tile,
    coverage: pairs whose tiles cover at least ``coverage`` of the item."""
    spark = docs.sparkSession
    path = scratch(spark, "tiling")
    bench = items.select(F.col("item_id").cast("long").alias("id"), row_key(F.col("item_id"), F.col("text")).alias("row_key"), "text")
    bench_seeds = written(_seed_rows(bench, min_match, None), f"{path}/items")
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), row_key(F.col("doc_id"), F.col("text")).alias("row_key"), "text")
    found = written(_seed_rows(rows, min_match, _bitmap(bench_seeds)), f"{path}/documents")
    left = found.select(F.col("id").alias("doc_id"), "row_key", "pos", "seed", "words").distinct()
    right = bench_seeds.select(
        F.col("id").alias("item_id"), F.col("row_key").alias("item_key"), F.col("pos").alias("at"), "seed",
        F.col("words").alias("item_words"), F.col("n").alias("n_item"),
    ).distinct()
    cands = written(candidates(left, right, min_match, coverage), f"{path}/candidates")
    # all seeds of the pairs that are left
    cands = cands.select(F.col("doc_id").alias("in_doc"), F.col("row_key").alias("in_row"), F.col("item_id").alias("of"), F.col("item_key").alias("of_key"))
    wanted = cands.join(right.withColumnRenamed("seed", "item_seed"), F.col("of").eqNullSafe(F.col("item_id")) & (F.col("of_key") == F.col("item_key")))
    same = F.col("doc_id").eqNullSafe(F.col("in_doc")) & (F.col("row_key") == F.col("in_row")) & (F.col("seed") == F.col("item_seed"))
    both = left.join(wanted, same).where(F.col("words") == F.col("item_words"))
    # seeds that cover too little of the item cannot make tiles that cover enough
    pairs = both.groupBy("doc_id", "row_key", "item_id", "item_key", "n_item").agg(
        F.collect_set(F.struct("pos", "at")).alias("matches"), F.size(F.collect_set("at")).alias("n_at")
    ).where(F.col("n_at") * min_match >= F.col("n_item") * coverage)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = [tiles([(m["pos"], m["at"]) for m in x.as_py()], min_match) for x in b.column("matches")]
            sizes = [[n for _, _, n in x] for x in done]
            names = ["doc_id", "row_key", "item_id", "n_item_words", "n_tiles", "n_covered", "longest_tile"]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("doc_id", "row_key", "item_id")), b.column("n_item").cast(pa.int64()),
                 *(pa.array(x, pa.int64()) for x in (map(len, sizes), map(sum, sizes), (max(x, default=0) for x in sizes)))],
                names,
            )

    scored = pairs.drop("n_at").mapInArrow(
        run, "doc_id long, row_key long, item_id long, n_item_words long, n_tiles long, n_covered long, longest_tile long"
    ).withColumn("coverage", F.col("n_covered") / F.col("n_item_words"))
    return scored.where(F.col("coverage") >= coverage)
