"""Helpers shared by the training-data operators.

Every operator selects the columns it needs from its input before it adds any
of its own, so extra columns of the input, whatever their names, never clash.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import scratch_root

# Fixed values of the contracts: ASCII white space, and ASCII capitals.
WHITE = " \t\n\x0b\x0c\r"
WHITE_CLASS = "[\\x20\\x09-\\x0D]"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder for one run's intermediate tables.

    It lies in the shared folder that the session names in
    ``spark.checkpoint.dir``; where that is unset, see :func:`scratch_root`.
    """
    return f"{scratch_root(spark)}/tidewater-llm/{name}-{uuid.uuid4().hex}"


def written(frame: DataFrame, path: str) -> DataFrame:
    """Cut the lineage: write ``frame`` as Parquet under ``path`` and read it.

    The files outlive lost executors, and their size tells Spark which side of
    a later join is small enough to broadcast.
    """
    frame.write.mode("overwrite").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` also folds other alphabets, so it is used
    where every character takes one byte, and ``translate`` elsewhere."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, CAPITALS, CAPITALS.lower())
    )


def row_key(doc_id: Column, text: Column) -> Column:
    """Identifies a document row by id and content: rows that repeat both are
    one, rows that share only the id stay apart, and nulls have keys too."""
    return F.xxhash64(doc_id.isNull(), doc_id, text.isNull(), text)


def without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """``docs`` less the rows whose (doc_id, row_key) is in ``rejected``; keeps
    the columns of ``docs``. The rejected grow with the documents, so they are
    joined by sort and merge at every size."""
    gone = rejected.select(F.col("doc_id").alias("__gone_id"), F.col("row_key").alias("__gone_key"))
    gone = gone.distinct().hint("merge")
    return docs.join(
        gone,
        docs["doc_id"].eqNullSafe(gone["__gone_id"])
        & (row_key(docs["doc_id"], docs["text"]) == gone["__gone_key"]),
        "left_anti",
    )


def without_rows(rows: DataFrame, rejected: DataFrame) -> DataFrame:
    """``rows`` (doc_id, row_key) less those in ``rejected``."""
    gone = rejected.select(F.col("doc_id").alias("__gone_id"), F.col("row_key").alias("__gone_key"))
    return rows.join(gone, rows["doc_id"].eqNullSafe(gone["__gone_id"]) & (rows["row_key"] == gone["__gone_key"]), "left_anti")
