"""SimHash near-duplicates by multi-index hashing.

Fingerprints are cut into segments. If two fingerprints differ in at most ``d``
bits, some segment differs in at most ``d // segments`` bits, so each distinct
fingerprint looks up, per segment, the small Hamming ball around its own segment
in the table of all segments; every match is verified on the complete distance.
A ball member is looked up only where it is not below the segment itself, which
finds each pair from one side. Exact copies share one fingerprint and are joined
back at the end, so a group of copies of any size is one vertex here.

Two 32-bit segments (radius one at three bits) keep the tables' buckets small at
tens of billions of documents, where four 16-bit tables would not.

Defined results: null and empty texts have fingerprint zero and link like any
other; the component of documents without any non-null id is null; repeated
rows each get a row; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import row_key, scratch, written
from tidewater.llm.components import connected_components

SHINGLE, MAX_BITS, SEGMENTS, SEED = 3, 3, 2, 42
BLOCK = 1 << 16  # shingles expanded to bits at a time


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Majority bits of the shingles' XXH64, as a signed long. ``bytes.lower``
    and ``bytes.split`` act on ASCII only."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = zip(*(words[k:] for k in range(shingle)), strict=False) if len(words) >= shingle else [words]
    join, digest = b" ".join, xxhash.xxh64_intdigest
    hashes = np.array([digest(join(g), SEED) for g in grams], dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), BLOCK):
        part = hashes[at : at + BLOCK].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, row_key, fp: one row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = pa.array([fingerprint(t.as_py(), shingle) for t in b.column("text")], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("row_key"), fp], ["doc_id", "row_key", "fp"])

    rows = docs.select(F.col("doc_id").cast("long"), row_key(F.col("doc_id"), F.col("text")).alias("row_key"), "text")
    return rows.mapInArrow(run, "doc_id long, row_key long, fp long")


def links(distinct: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS) -> DataFrame:
    """(u, v), u and v from ``distinct.fp``, that differ in 1 to max_bits bits.
    ``segments`` is at least two."""
    edges = [64 * k // segments for k in range(segments + 1)]
    parts = []
    for k, (low, high) in enumerate(zip(edges, edges[1:], strict=False)):
        width = high - low
        mask = (1 << width) - 1
        segment = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit(mask if width < 64 else -1))
        ball = [sum(1 << i for i in bits) for r in range(max_bits // segments + 1) for bits in combinations(range(width), r)]
        parts.append(distinct.select(F.lit(k).alias("k"), segment.alias("segment"), F.array(*map(F.lit, ball)).cast("array<long>").alias("ball"), "fp"))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    table = rows.select("k", F.col("segment").alias("key"), F.col("fp").alias("v"))
    s = F.col("segment")
    members = F.filter(F.transform("ball", lambda m: s.bitwiseXOR(m)), lambda key: key >= s)
    probes = rows.select("k", F.explode(members).alias("key"), "segment", F.col("fp").alias("u"))
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits
    once = (F.col("key") != F.col("segment")) | (F.col("u") < F.col("v"))
    return probes.join(table, ["k", "key"]).where(near & once).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, segments: int = SEGMENTS
) -> DataFrame:
    """doc_id, row_key, fp, component_id: the smallest doc_id that can be reached
    over fingerprints at most ``max_bits`` apart; group_fp: the least fingerprint
    of the component, which one without any id has too."""
    spark = docs.sparkSession
    path = scratch(spark, "simhash")
    fps = written(fingerprints(docs, shingle), f"{path}/fingerprints")
    distinct = written(fps.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), f"{path}/distinct")
    labels = written(connected_components(links(distinct.select("fp"), max_bits, segments)), f"{path}/labels")
    linked = labels.join(distinct, labels["vertex"] == distinct["fp"]).select("vertex", "label", "least")
    ids = linked.groupBy("label").agg(F.min("least").alias("component"))
    named = linked.join(ids, "label").select(F.col("vertex").alias("linked_fp"), "label", "component")
    classes = distinct.join(named, distinct["fp"] == named["linked_fp"], "left").select(
        F.col("fp").alias("class_fp"), F.coalesce("component", "least").alias("component_id"),
        F.coalesce("label", "fp").alias("group_fp"), "n",
    )
    classes = written(classes, f"{path}/classes")
    # a fingerprint of more than a thousandth of the rows: under a thousand of them, whatever the input
    rows = distinct.agg(F.sum("n")).first()[0] or 0
    many = F.col("n") * 1000 > rows
    hot, other = F.broadcast(classes.where(many)), classes.where(~many)
    joined = fps.join(hot, fps["fp"] == hot["class_fp"]).unionByName(
        fps.join(hot, fps["fp"] == hot["class_fp"], "left_anti").join(other, F.col("fp") == F.col("class_fp"))
    )
    return joined.select("doc_id", "row_key", "fp", "component_id", "group_fp")
