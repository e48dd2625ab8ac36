"""A training corpus from ``documents``, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before
kept, and calls one operator of :mod:`tidewater.llm`. All but the last return the
columns of ``documents``; the last returns the token ids' digests.
"""

from __future__ import annotations

import re

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import bpe, line_dedup, quality, simhash, tiling
from tidewater.llm.common import benchmark, documents, row_key, scratch, without, without_rows, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the robust distance rejects go."""
    verdicts = quality.robust_quality(docs)
    rejected = verdicts.where(~F.col("kept")).select("doc_id", "row_key")
    return without(docs, written(rejected, scratch(spark, "rejected")))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a document with a smaller id holds go."""
    return line_dedup.dedup_lines(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document with the smallest id stays;
    among texts that share this id or have none, the one with the least row key.
    Rows that repeat an id (or its absence) and a text are one document: nothing
    but their other columns tells them apart, and the least of them stays."""
    path = scratch(spark, "copies")
    groups = written(simhash.near_duplicates(docs), f"{path}/groups")
    least = groups.where("doc_id <=> component_id")
    several = least.groupBy("group_fp").agg(F.min("row_key").alias("first"), F.max("row_key").alias("last")).where("first < last")
    twins = least.join(several.hint("merge"), "group_fp").where("row_key > first")
    rejected = groups.where("not (doc_id <=> component_id)").select("doc_id", "row_key").unionByName(twins.select("doc_id", "row_key"))
    rejected = written(rejected.distinct(), f"{path}/rejected")
    repeated = groups.groupBy("doc_id", "row_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id", "row_key")
    repeated = written(without_rows(repeated, rejected), f"{path}/repeated")
    once = without(docs, rejected.unionByName(repeated))
    return once.unionByName(_least_of_each(docs, repeated))


def _least_of_each(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """One row of ``docs`` for each (doc_id, row_key) of ``repeated``. Rows are
    compared by their columns other than maps and intervals, which have no order."""
    names = [f"`{c}`" for c in docs.columns]
    ordered = [f.name for f in docs.schema.fields if not re.search("map<|interval|variant", f.dataType.simpleString())]
    keys = repeated.select(F.col("doc_id").alias("__id"), F.col("row_key").alias("__key"))
    same = docs["doc_id"].eqNullSafe(keys["__id"]) & (row_key(docs["doc_id"], docs["text"]) == keys["__key"])
    rows = docs.join(keys, same).groupBy("__id", "__key").agg(
        F.min_by(F.struct(*names), F.struct(F.lit(0), *[f"`{c}`" for c in ordered])).alias("__row")
    )
    return rows.select(*[F.col("__row").getField(c).alias(c) for c in docs.columns])


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold enough of a benchmark item go."""
    found = tiling.contaminated(docs, benchmark(spark, sf_dir)).select("doc_id", "row_key").distinct()
    return without(docs, written(found, scratch(spark, "leaks")))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining text, encoded and decoded again."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(docs, path, public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("byte_bpe", byte_bpe),
]

#: SQL has no MCD estimate, XXH64 or tokenizer; tests use a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    path = scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"{path}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
