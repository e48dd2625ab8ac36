"""Line deduplication with keep bitmaps, by range partitions and a secondary sort.

Lines travel as 128-bit digests with document and position, never as text. They
are range-partitioned by digest and sorted by document and position inside each
digest; a window streams over the sorted rows, and every row whose document is
not the digest's first is dropped. What comes back per document is a bitmap in
64-line words, without the words in which every line stays.

A digest that holds a large share of all lines is split: a sample of documents
finds such digests (it only plans the split, the result does not depend on it),
their rows are salted by document, and the few first documents of each salt meet
in a second, small pass.

Defined results: a null or empty text is one empty line; a null doc_id is one
document that comes after all others; rows that repeat a doc_id are one document
(their common lines drop nothing from each other), each row with its own bitmap;
an empty table gives an empty result. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewater.llm.common import WHITE, ascii_lower, row_key, scratch, written

MIN_CHARS = 10
#: Share of documents sampled to find digests worth splitting, the least count
#: in that sample, and the least share of its lines (at most 1 / HOT_SHARE such).
SAMPLE, HOT_COUNT, HOT_SHARE = 0.01, 20, 0.0002


def _keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """h1, h2, doc_id, row_key, pos of every line that is long enough."""
    lines = docs.select(
        "doc_id", row_key(F.col("doc_id"), F.col("text")).alias("row_key"),
        F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("pos", "line"),
    ).withColumn("bare", F.btrim("line", F.lit(WHITE))).where(F.length("bare") >= min_chars)
    lines = lines.withColumn("key", ascii_lower(F.col("bare")))
    return lines.select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc_id", "row_key", "pos"
    )


def _hot(docs: DataFrame, min_chars: int) -> DataFrame:
    """hot, salts: digests to split, and into how many parts."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = _keys(docs.sample(fraction=SAMPLE, seed=7), min_chars).groupBy("h1").agg(F.count(F.lit(1)).alias("n"))
    total = n.agg(F.sum("n").alias("total")).first()["total"] or 0
    return n.where((F.col("n") >= HOT_COUNT) & (F.col("n") >= F.lit(HOT_SHARE * total))).select(
        F.col("h1").alias("hot"), F.ceil(F.col("n") / F.lit(max(total, 1)) * 4 * partitions).cast("int").alias("salts")
    )


def _ranged(docs: DataFrame, hot: DataFrame, min_chars: int) -> DataFrame:
    """The rows of ``_keys`` with their salt (0: not split), range-partitioned."""
    rows = _keys(docs, min_chars)
    salt = F.when(F.col("salts") > 1, 1 + F.pmod(F.xxhash64("doc_id"), F.col("salts"))).otherwise(F.lit(0))
    rows = rows.join(hot, rows["h1"] == hot["hot"], "left").withColumn("salt", salt).drop("hot", "salts")
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(partitions, "h1", "salt")


def _first_documents(rows: DataFrame, *group: str) -> DataFrame:
    """Adds ``later``: true unless the row's document is the first of its group."""
    w = W.partitionBy(*group).orderBy(F.col("doc_id").asc_nulls_last(), "row_key", "pos")
    first = F.first("doc_id").over(w.rowsBetween(W.unboundedPreceding, W.currentRow))
    return rows.withColumn("later", ~F.col("doc_id").eqNullSafe(first))


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, row_key, n_dropped and ``keep`` for documents that lose lines:
    ``keep`` lists (word, bits), bit p of word w set if line 64 w + p stays;
    words that are not listed keep all their lines."""
    spark = docs.sparkSession
    path = scratch(spark, "lines")
    hot = written(_hot(docs, min_chars).coalesce(1), f"{path}/hot")
    level1 = _first_documents(_ranged(docs, hot, min_chars), "h1", "h2", "salt").where(F.col("later") | (F.col("salt") > 0))
    level1 = written(level1, f"{path}/first")
    level2 = _first_documents(level1.where(~F.col("later")).drop("later"), "h1", "h2")
    dropped = level1.where("later").unionByName(level2.where("later"))
    words = dropped.groupBy("doc_id", "row_key", F.expr("pos div 64").cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(pos % 64))")).alias("bits")
    )
    return words.groupBy("doc_id", "row_key").agg(
        F.sum(F.bit_count("bits")).cast("long").alias("n_dropped"),
        F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("bits").alias("bits")))).alias("keep"),
    )


def _kept_text(text: Column, dense: Column) -> Column:
    def stays(_: Column, i: Column) -> Column:
        bits = F.get(dense, F.floor(i / 64).cast("int"))
        return bits.isNull() | (F.call_function("getbit", bits, (i % 64).cast("int")) == 1)

    return F.array_join(F.filter(F.split(text, "\n"), stays), "\n")


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """doc_id, text cut to the kept lines, n_lines, n_dropped, and ``row`` with all
    columns of ``docs``. Texts that lose nothing are returned as they are. The
    bitmaps grow with the documents: they are joined by sort and merge."""
    b = written(bitmaps, scratch(docs.sparkSession, "bitmaps")).withColumnsRenamed({"doc_id": "id", "row_key": "lost"})
    b = b.hint("merge")
    d = docs.select(
        "doc_id", "text", row_key(F.col("doc_id"), F.col("text")).alias("row_key"), F.struct(*docs.columns).alias("row")
    )
    out = d.join(b, d["doc_id"].eqNullSafe(b["id"]) & (d["row_key"] == b["lost"]), "left")
    words = F.map_from_entries("keep")
    dense = F.transform(F.sequence(F.lit(0), F.element_at("keep", -1)["word"]), lambda i: words[i])
    text = F.coalesce("text", F.lit(""))
    n_lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    cut = F.when(F.col("dense").isNotNull(), _kept_text(F.col("text"), F.col("dense"))).otherwise(F.col("text"))
    return out.withColumn("dense", F.when(F.col("keep").isNotNull(), dense)).select(
        "doc_id", cut.alias("text"), n_lines.cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"), "row",
    )


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` without the lines that a document with a smaller id holds."""
    out = apply_bitmaps(docs, keep_bitmaps(docs, min_chars))
    return out.select(F.col("row").withField("text", F.col("text")).alias("row")).select("row.*")
