"""Exact token-length histogram and its suffix sums.

Each text is encoded to learn its length in tokens, and documents are counted by
length, map-side first, so from here on the data has at most one row per distinct
length. Suffix sums over it answer, for every context limit, how many documents
and tokens fit, how many documents are longer, and how many tokens remain when
the longer ones are truncated; quantiles are read off the running counts. The
sums go by blocks of lengths, first over the few blocks and then inside each.

Defined results: null and empty texts have length zero; repeated rows count each;
an empty table gives an empty histogram.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewater.llm import bpe
from tidewater.llm.common import scratch, written

BLOCK = 4096


def lengths(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """n_tokens of every document."""
    with open(ranks_path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.Encoder(bpe.vocabulary(shared.value), pattern)
        for batch in (part for whole in batches for part in bpe.text_chunks(whole)):
            rows = encoder.learn([t or "" for t in batch.column("text").to_pylist()])
            n = np.array([encoder.counts[r].sum() for r in rows], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(n)], ["n_tokens"])

    return docs.select(F.col("text").cast("string")).mapInArrow(run, "n_tokens long")


def histogram(counts: DataFrame) -> DataFrame:
    """n_tokens, n_docs."""
    return counts.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def suffix_sums(hist: DataFrame) -> DataFrame:
    """For every length that occurs, as a context limit: n_docs of just that
    length, docs_longer and tokens_longer (over the limit), docs_fit and
    tokens_fit (up to it), truncated_tokens (all documents cut to the limit) and
    ``quantile``, the share of documents that fit."""
    tokens = F.col("n_tokens") * F.col("n_docs")
    hist = written(hist, scratch(hist.sparkSession, "lengths"))  # read twice below, encoded once
    h = hist.withColumn("block", F.floor(F.col("n_tokens") / BLOCK))
    blocks = h.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum(tokens).alias("t"))
    above = W.orderBy(F.col("block").desc()).rowsBetween(W.unboundedPreceding, -1)
    everything = W.orderBy("block").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    blocks = blocks.select(
        F.col("block").alias("of"),
        F.coalesce(F.sum("d").over(above), F.lit(0)).alias("d_above"), F.coalesce(F.sum("t").over(above), F.lit(0)).alias("t_above"),
        F.sum("d").over(everything).alias("d_all"), F.sum("t").over(everything).alias("t_all"),
    )
    inside = W.partitionBy("block").orderBy(F.col("n_tokens").desc()).rowsBetween(W.unboundedPreceding, -1)
    longer = F.coalesce(F.sum("n_docs").over(inside), F.lit(0)), F.coalesce(F.sum(tokens).over(inside), F.lit(0))
    h = h.withColumns({"d_longer": longer[0], "t_longer": longer[1]}).join(blocks, h["block"] == blocks["of"])
    h = h.withColumns({"docs_longer": F.col("d_longer") + F.col("d_above"), "tokens_longer": F.col("t_longer") + F.col("t_above")})
    return h.select(
        "n_tokens", "n_docs", "docs_longer", "tokens_longer",
        (F.col("d_all") - F.col("docs_longer")).alias("docs_fit"), (F.col("t_all") - F.col("tokens_longer")).alias("tokens_fit"),
        (F.col("t_all") - F.col("tokens_longer") + F.col("n_tokens") * F.col("docs_longer")).alias("truncated_tokens"),
        ((F.col("d_all") - F.col("docs_longer")) / F.col("d_all")).alias("quantile"),
    )


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """context_limit, docs_fit, tokens_fit, docs_longer, truncated_tokens for limits
    that need not occur as a length: the greatest length up to each decides."""
    spark = sums.sparkSession
    all_docs = sums.agg(F.sum("n_docs").alias("d")).first()["d"] or 0
    asked = spark.createDataFrame([(x,) for x in limits], "context_limit long")
    lower = sums.select("n_tokens", "docs_fit", "tokens_fit")
    steps = F.explode(F.array(*[F.lit(x) for x in limits])).alias("context_limit")
    best = lower.select("*", steps).where("n_tokens <= context_limit").groupBy("context_limit").agg(
        F.max_by(F.struct("docs_fit", "tokens_fit"), "n_tokens").alias("b")
    )
    fit = asked.join(best, "context_limit", "left")
    docs, tokens = F.coalesce("b.docs_fit", F.lit(0)), F.coalesce("b.tokens_fit", F.lit(0))
    return fit.select(
        "context_limit", docs.alias("docs_fit"), tokens.alias("tokens_fit"), (F.lit(all_docs) - docs).alias("docs_longer"),
        (tokens + F.col("context_limit") * (F.lit(all_docs) - docs)).alias("truncated_tokens"),
    )


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """share, n_tokens: the least length that at least this share of documents
    does not exceed."""
    step = F.explode(F.array(*[F.lit(float(x)) for x in shares])).alias("share")
    return sums.select("n_tokens", "quantile", step).where("quantile >= share").groupBy("share").agg(F.min("n_tokens").alias("n_tokens"))
