"""Mixing sources to target weights by systematic sampling.

Every source gets a target in words, and every document of a source the same
expected number of copies, the source's target over its size. The documents of a
source stand in the order of their sizes; the running sum of their expected
copies plus one random offset of the source passes whole numbers, and a document
is taken once for each whole number that is passed at it. So a document's copies
are its expectation rounded down or up, and as neighbours in the order are of
nearly one size, the words taken differ from the target by about the largest
document's size at most, however many documents there are.

Expectations are whole billionths and their sums exact decimals, so no sum
depends on the order of additions. DataFrame functions only: one pass over the
texts for their sizes, then narrow rows.

Defined results: a null or empty text has size zero and is taken by the same
rule; a null source is a source of its own and the last one; repeated rows each
get a row, and which of several rows alike in every column is taken is open; an
empty table gives an empty result. ``seed`` fixes the offsets, so reruns agree.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import row_key, scratch, written
from tidewater.llm.positions import with_positions

WORD = "[^\\x20\\x09-\\x0D]+"
#: Weights of the sources in order, repeating; words to take as a share of all
#: words; and the most copies of a document, and of a source.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
UNIT = 1_000_000_000


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, row_key and size, the number of words, of every row."""
    n = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD))
    return docs.select("doc_id", "source", row_key(F.col("doc_id"), F.col("text")).alias("row_key"), n.cast("long").alias("size"))


def targets(
    sized: DataFrame, path: str, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """source, source_size, weight, target, rate: one row per source.

    All sources below ``most`` times their size stand at one level of words per
    weight. What the others cannot take raises this level, round by round, until
    none of those left is above its bound. A round is one aggregate of one row.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = with_positions(totals.withColumn("all", F.lit(0)), "all", [F.col("source").asc_nulls_last()], f"{path}/sources")
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.col("position") % len(weights))
    sources = written(placed.select("source", "source_size", weight.alias("weight")), f"{path}/weights")
    bound = F.col("source_size") * float(most)
    wanted = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:
        full = bound <= F.lit(level) * F.col("weight")
        at_bound, free = sources.agg(F.sum(F.when(full, bound)), F.sum(F.when(~full, F.col("weight")))).first()
        rise = (wanted - (at_bound or 0.0)) / free if free else math.inf
        if rise <= level:
            break
        level = rise
    target = F.least(bound, F.lit(level) * F.col("weight")) if level < math.inf else bound
    rate = F.floor(F.try_divide(target, F.col("source_size").cast("double")) * UNIT).cast("long")
    return sources.withColumn("target", target).withColumn("rate", F.coalesce(rate, F.lit(0).cast("long")))


def offset(source: Column, seed: int) -> Column:
    """The random offset of a source, in billionths."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("="), source), F.lit("-"))), 256)
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") % UNIT


def mix(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = 0
) -> DataFrame:
    """One row per document: doc_id, source, row_key, size, source_size, target
    (of its source) and ``copies``, how often the mix takes it."""
    path = scratch(docs.sparkSession, "mix")
    sized = written(sizes(docs), f"{path}/sizes")
    plan = written(targets(sized, path, weights, share, most).withColumn("offset", offset(F.col("source"), seed)), f"{path}/targets")
    placed = with_positions(sized, "source", [F.col(c).asc_nulls_first() for c in ("size", "doc_id", "row_key")], f"{path}/order")
    rows = placed.join(plan.withColumnRenamed("source", "of"), placed["source"].eqNullSafe(F.col("of")))
    passed = lambda p: f"(CAST({p} AS DECIMAL(20, 0)) * CAST(rate AS DECIMAL(12, 0)) + offset) DIV {UNIT}"
    copies = F.expr(f"{passed('(position + 1)')} - {passed('position')}")
    return rows.select("doc_id", "source", "row_key", "size", "source_size", "target", copies.alias("copies"))


def emit(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as ``mixed`` (from
    :func:`mix`) takes it, with ``copy`` numbered from 1.

    Rows that agree in doc_id, source and text share their copies evenly; what
    does not divide evenly is taken from one of them.
    """
    group = mixed.groupBy(
        F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("row_key").alias("__key")
    ).agg(F.sum("copies").alias("__copies"), F.count(F.lit(1)).alias("__rows"))
    group = group.where("__copies > 0").selectExpr(
        "__id", "__source", "__key", "CAST(__copies DIV __rows AS INT) AS __each", "CAST(__copies % __rows AS INT) AS __rest"
    )
    key = row_key(docs["doc_id"], docs["text"])
    same = docs["doc_id"].eqNullSafe(group["__id"]) & docs["source"].eqNullSafe(group["__source"]) & (key == group["__key"])
    rows = docs.join(group, same)
    numbers = lambda first, n: F.explode(F.sequence(first, first + n - 1)).alias("copy")
    each = rows.where("__each > 0").select(*docs.columns, numbers(F.lit(1), F.col("__each")))
    one = rows.where("__rest > 0").groupBy("__id", "__source", "__key").agg(
        F.first(F.struct(*docs.columns)).alias("row"), F.first("__each").alias("__each"), F.first("__rest").alias("__rest")
    )
    rest = one.select("row.*", numbers(F.col("__each") + 1, F.col("__rest")))
    return each.unionByName(rest)
