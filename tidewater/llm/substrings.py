"""Removal of long repeated byte strings, across and within documents.

Every window of ``length`` bytes belongs to the least k-mer it holds (by digest,
leftmost among equals), so equal windows always meet under the same k-mer, their
anchor. Consecutive windows with one anchor form a run of about eighty; a run is
known by its anchor and a digest of all its bytes.

1. A scan counts runs per anchor, with the least and greatest run digest.
   Anchors that occur once cannot hold a repeated window.
2. A fixed-size bitmap of the other anchors goes to a second scan, which writes
   only their runs, and a run's bytes where its anchor has different runs. The
   bitmap only filters; what passes by chance changes nothing.
3. Runs that occur twice as a whole are repeated in full. The different runs of
   one anchor meet in blocks of about ``BLOCK_BYTES``, where threshold-bounded
   interval expansion on a Burrows-Wheeler transform finds their repeated windows
   (:mod:`tidewater.llm.bwt`). The runs of an anchor too large for a block are cut
   again, by the least k-mer of another order of digests: equal windows still meet,
   under both k-mers, and the parts go through the same steps. Windows that stay
   together in ``LEVELS`` orders are counted by Spark, by 128-bit digest.
4. The covered ranges go back to the documents, which are cut in place.

Text that repeats nowhere is scanned but not shuffled until step 4; copies are
one run each, however many there are.

Defined results: null and empty texts have no bytes; rows that repeat a document
are documents of their own, so all their long strings repeat; an empty table
gives an empty result; texts under ``length`` bytes never lose any.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm import bwt
from tidewater.llm.common import row_key, scratch, written

LENGTH, KMER = 200, 32
BITS = 26  # the anchors' bitmap has 2 ** BITS bits, eight megabytes
BLOCK_BYTES, HOT_BYTES = 1 << 20, 1 << 22
LEVELS = 4  # orders of k-mers by which the runs of a hot anchor are cut
SEGMENT = 1 << 22  # windows of one text handled at a time
BASE = np.uint64(0x9E3779B97F4A7C15)
PLACE = np.uint64((1 << 24) - 1)


def _kmer_digests(data: np.ndarray, kmer: int, level: int = 0) -> np.ndarray:
    """Digest of the ``kmer`` (a power of two) bytes from each place on, by
    doubling; each ``level`` has an order of its own."""
    h = data.astype(np.uint64) + np.uint64(1)
    size, factor = 1, int(BASE)
    while size < kmer:
        h = h[:-size] * np.uint64(factor) + h[size:]
        size, factor = 2 * size, factor * factor % 2**64
    for turn in range(level + 1):
        if turn:
            h ^= np.uint64(turn)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return h


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (width - size)], x[width - size :]) if size < width else x


def runs(data: bytes, length: int = LENGTH, kmer: int = KMER, level: int = 0) -> Iterator[tuple[int, int, int, int]]:
    """(start, windows, anchor, digest) of each run of ``data``, in order; anchor
    and digest as signed longs."""
    for begin in range(0, len(data) - length + 1, SEGMENT):
        part = data[begin : begin + SEGMENT + length - 1]
        h = _kmer_digests(np.frombuffer(part, dtype=np.uint8), kmer, level)
        order = (h & ~PLACE) | np.arange(len(h), dtype=np.uint64)
        least = _sliding_least(order, length - kmer + 1)
        cut = np.flatnonzero(least[1:] != least[:-1]) + 1
        starts = np.append(0, cut)
        anchors = h[(least[starts] & PLACE).astype(np.int64)].view(np.int64)
        for a, b, anchor in zip(starts.tolist(), [*cut.tolist(), len(least)], anchors.tolist(), strict=True):
            digest = xxhash.xxh3_64_intdigest(part[a : b + length - 1])
            yield begin + a, b - a, anchor, digest - (digest >> 63 << 64)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long"), row_key(F.col("doc_id"), F.col("text")).alias("row_key"),
        F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("data"),
    )


def _repeated_anchors(docs: DataFrame, length: int) -> DataFrame:
    """anchor, mixed: anchors that occur twice, and whether with different runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                found = [r[2:] for d in batch.column("data").slice(at, 512) for r in runs(d.as_py(), length)]
                table = np.array(found, dtype=np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(table[:, 0]), pa.array(table[:, 1])], ["anchor", "digest"])

    n = _rows(docs).mapInArrow(run, "anchor long, digest long").groupBy("anchor").agg(
        F.count(F.lit(1)).alias("n"), F.min("digest").alias("low"), F.max("digest").alias("high")
    )
    return n.where("n > 1").select("anchor", (F.col("low") != F.col("high")).alias("mixed"))


def _bitmap(anchors: DataFrame) -> bytes:
    """Bit (anchor mod 2 ** BITS) for every anchor, made by Spark in pieces of
    32768 bits, at most 2 ** BITS / 32768 of which reach the driver."""
    slot = F.col("anchor").bitwiseAND(F.lit((1 << BITS) - 1))
    pieces = anchors.select(F.shiftright(slot, 15).alias("piece"), slot.bitwiseAND(F.lit(32767)).alias("bit"))
    out = np.zeros(1 << BITS >> 3, dtype=np.uint8)
    for r in pieces.groupBy("piece").agg(F.bitmap_construct_agg("bit").alias("bits")).toLocalIterator():
        out[r["piece"] * 4096 : r["piece"] * 4096 + 4096] = np.frombuffer(r["bits"], dtype=np.uint8)
    return out.tobytes()


def _candidate_runs(docs: DataFrame, anchors: DataFrame, length: int) -> DataFrame:
    """Runs whose anchor's bit is set; ``context`` holds the bytes of a run with a
    mixed anchor, once per task and distinct run."""
    sc = docs.sparkSession.sparkContext
    repeated, mixed = sc.broadcast(_bitmap(anchors)), sc.broadcast(_bitmap(anchors.where("mixed")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def bit(bits: bytes, anchor: int) -> int:
            slot = anchor & ((1 << BITS) - 1)
            return bits[slot >> 3] >> (slot & 7) & 1

        for batch in batches:
            sent: set[tuple[int, int]] = set()
            for at in range(0, batch.num_rows, 512):
                b = batch.slice(at, 512)
                out: list[tuple] = []
                for k, d in enumerate(b.column("data")):
                    data = d.as_py()
                    for start, size, anchor, digest in runs(data, length):
                        if bit(repeated.value, anchor):
                            context = None
                            if bit(mixed.value, anchor) and (anchor, digest) not in sent:
                                sent.add((anchor, digest))
                                context = data[start : start + size + length - 1]
                            out.append((k, start, size, anchor, digest, context))
                k, start, size, anchor, digest, context = zip(*out, strict=True) if out else [()] * 6
                which = pa.array(k, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(which), b.column("row_key").take(which), pa.array(start, pa.int32()), pa.array(size, pa.int32()),
                     pa.array(anchor, pa.int64()), pa.array(digest, pa.int64()), pa.array(context, pa.binary())],
                    ["doc_id", "row_key", "start", "size", "anchor", "digest", "context"],
                )

    return _rows(docs).mapInArrow(
        run, "doc_id long, row_key long, start int, size int, anchor long, digest long, context binary"
    )


RANGES = "anchor long, digest long, ranges array<struct<low:int,high:int>>"


def _covered(starts: np.ndarray, length: int) -> list[dict[str, int]]:
    """Ranges covered by windows at ``starts`` (ascending)."""
    if not len(starts):
        return []
    cut = np.flatnonzero(starts[1:] > starts[:-1] + length) + 1
    low, high = starts[np.append(0, cut)], starts[np.append(cut - 1, len(starts) - 1)] + length
    return [{"low": a, "high": b} for a, b in zip(low.tolist(), high.tolist(), strict=True)]


def _in_blocks(contexts: DataFrame, length: int) -> DataFrame:
    """Repeated windows of contexts, by interval expansion in blocks of anchors."""
    total = contexts.agg(F.sum(F.octet_length("context"))).first()[0] or 0
    blocks = max(1, total // BLOCK_BYTES)

    def run(table: pa.Table) -> pa.Table:
        found = bwt.repeated_windows([c.as_py() for c in table.column("context")], length)
        ranges = [_covered(s, length) for s in found]
        kind = pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))
        out = pa.table([table.column("anchor"), table.column("digest"), pa.array(ranges, kind)], ["anchor", "digest", "ranges"])
        return out.filter(pa.array([bool(r) for r in ranges], pa.bool_()))

    block = F.pmod(F.xxhash64("anchor"), F.lit(blocks)).alias("block")
    return contexts.select(block, "anchor", "digest", "context").groupBy("block").applyInArrow(run, RANGES)


def _by_count(contexts: DataFrame, length: int) -> DataFrame:
    """Repeated windows of contexts whose anchor has too many of them for a block:
    every window is digested, and equal digests are counted map-side first."""
    at = F.explode(F.sequence(F.lit(0), F.octet_length("context") - length)).alias("at")
    window = F.substring("context", F.col("at") + 1, F.lit(length))
    w = contexts.select("anchor", "digest", "context", at).select(
        "anchor", "digest", "at", F.xxhash64(window).alias("w1"), F.xxhash64(F.lit(1), window).alias("w2")
    )
    twice = w.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    low = F.col("at").cast("int")
    return w.join(twice, ["w1", "w2"]).groupBy("anchor", "digest").agg(
        F.collect_list(F.struct(low.alias("low"), (low + length).alias("high"))).alias("ranges")
    )


def _cut_again(contexts: DataFrame, length: int, level: int) -> DataFrame:
    """The parts of contexts by the least k-mer of order ``level``: of (of_anchor,
    of_digest), from ``start`` on; their anchor stands for both k-mers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                rows = batch.slice(at, 4096).to_pydict()
                out = [
                    (a, d, start, size, second, digest, c[start : start + size + length - 1])
                    for a, d, c in zip(rows["anchor"], rows["digest"], rows["context"], strict=True)
                    for start, size, second, digest in runs(c, length, level=level)
                ]
                columns = list(zip(*out, strict=True)) or [()] * 7
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
                names = ["of_anchor", "of_digest", "start", "size", "second", "digest", "context"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    parts = contexts.select("anchor", "digest", "context").mapInArrow(
        run, "of_anchor long, of_digest long, start int, size int, second long, digest long, context binary"
    )
    return parts.withColumn("anchor", F.xxhash64("of_anchor", "second")).drop("second")


def _ranges(found: DataFrame, length: int, hot_bytes: int, path: str, level: int = 1) -> DataFrame:
    """anchor, digest, ranges: the repeated windows of the runs ``found`` (anchor,
    digest, size, and at least one ``context`` where the anchor has other runs)."""
    full = found.groupBy("anchor", "digest").agg(F.count(F.lit(1)).alias("n"), F.first("size").alias("size")).where("n > 1")
    whole = F.array(F.struct(F.lit(0).alias("low"), (F.col("size") + length - 1).cast("int").alias("high")))
    contexts = found.where("context is not null").groupBy("anchor", "digest").agg(F.first("context").alias("context"))
    contexts = written(contexts, f"{path}/contexts{level}")
    sizes = contexts.groupBy(F.col("anchor").alias("hot")).agg(F.sum(F.octet_length("context")).alias("bytes"))
    hot = written(sizes.where(F.col("bytes") > hot_bytes).select("hot"), f"{path}/hot{level}")
    cold = contexts.join(hot, contexts["anchor"] == hot["hot"], "left_anti")
    large = contexts.join(hot, contexts["anchor"] == hot["hot"], "left_semi")
    ranges = full.select("anchor", "digest", whole.alias("ranges")).unionByName(_in_blocks(cold, length))
    if hot.isEmpty():
        return ranges
    if level == LEVELS:
        return ranges.unionByName(_by_count(large, length))
    parts = written(_cut_again(large, length, level), f"{path}/parts{level}")
    inner = written(_ranges(parts, length, hot_bytes, path, level + 1), f"{path}/ranges{level}")
    back = parts.drop("context", "size").join(inner, ["anchor", "digest"]).select(
        F.col("of_anchor").alias("anchor"), F.col("of_digest").alias("digest"), "start", F.explode("ranges").alias("r")
    )
    moved = F.struct((F.col("start") + F.col("r.low")).cast("int").alias("low"), (F.col("start") + F.col("r.high")).cast("int").alias("high"))
    return ranges.unionByName(back.groupBy("anchor", "digest").agg(F.collect_set(moved).alias("ranges")))


def repeated_ranges(docs: DataFrame, length: int = LENGTH, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """doc_id, row_key, spans: sorted byte ranges (low, high) of each document that
    are covered by strings of ``length`` bytes that also start elsewhere."""
    path = scratch(docs.sparkSession, "substrings")
    anchors = written(_repeated_anchors(docs, length), f"{path}/anchors")
    found = written(_candidate_runs(docs, anchors, length), f"{path}/runs")
    ranges = written(_ranges(found, length, hot_bytes, path), f"{path}/ranges")
    spans = found.drop("context").join(ranges, ["anchor", "digest"]).select(
        "doc_id", "row_key", "start", F.explode("ranges").alias("range")
    ).distinct()
    span = F.struct((F.col("start") + F.col("range.low")).alias("low"), (F.col("start") + F.col("range.high")).alias("high"))
    return spans.groupBy("doc_id", "row_key").agg(F.sort_array(F.collect_list(span)).alias("spans"))


def merged(spans: list[dict[str, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the sorted ``spans``; ranges that touch are one."""
    out: list[tuple[int, int]] = []
    for s in spans:
        if out and s["low"] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], s["high"]))
        else:
            out.append((s["low"], s["high"]))
    return out


def remove_repeated(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, and the ``kept`` bytes."""
    spans = written(repeated_ranges(docs, length), scratch(docs.sparkSession, "spans"))
    spans = spans.withColumnsRenamed({"doc_id": "id", "row_key": "key"})
    rows = _rows(docs)
    both = rows.join(spans, rows["doc_id"].eqNullSafe(spans["id"]) & (rows["row_key"] == spans["key"]), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                b = batch.slice(at, 512)
                sizes, removed, n_spans, kept = [], [], [], []
                for d, s in zip(b.column("data"), b.column("spans"), strict=True):
                    data, gone = d.as_py(), merged(s.as_py() or [])
                    edges = [0, *(x for r in gone for x in r), len(data)]
                    kept.append(b"".join(data[a:z] for a, z in zip(edges[::2], edges[1::2], strict=True)))
                    sizes.append(len(data))
                    removed.append(len(data) - len(kept[-1]))
                    n_spans.append(len(gone))
                longs = [pa.array(x, pa.int64()) for x in (sizes, removed, n_spans)]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), *longs, pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
                )

    return both.select("doc_id", "data", "spans").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )
