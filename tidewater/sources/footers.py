"""Which Parquet files share one schema, found by one Spark job over their footers.

Files of a table need not agree: a month restored from elsewhere may lack a
column, or store it as another type, and Spark's schema merge refuses such files
as a whole. Here every task opens the footers of its files and gives each file a
signature of its columns' names and types. Files with one signature are one scan,
whose schema Spark reads from one of them; so no column of any file is lost
whatever the other files hold, and a column that a file lacks can be told from one
that is NULL. The driver makes no call per file.

Footers are opened with pyarrow, which reads local paths, HDFS and the common
object stores. Files in a store that only Spark's own readers open come back
without a signature; those alone are told apart by schemas that Spark reads one
file at a time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Hadoop's names of the S3 connector, and pyarrow's.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}


@dataclass(frozen=True)
class SchemaGroup:
    """Files or directories that hold one schema."""

    signature: str
    paths: list[str]


def footer_reader() -> Callable[[str], str]:
    """A function that opens a file's footer and returns a digest of its columns'
    names and types, whatever their order. It refers to nothing of this package, so
    that tasks can run it on executors that have only Spark and pyarrow."""
    schemes = dict(_SCHEMES)

    def footer(path: str) -> pq.FileMetaData:
        scheme, colon, rest = path.partition(":")
        if not colon or scheme == "file":
            return pq.read_metadata(re.sub("^file:/+", "/", path))
        store, inner = pyarrow.fs.FileSystem.from_uri(f"{schemes.get(scheme, scheme)}:{rest}")
        with store.open_input_file(inner) as source:
            return pq.read_metadata(source)

    def signature(path: str) -> str:
        found = footer(path)
        columns = (found.schema.column(i) for i in range(found.num_columns))
        spelled = sorted(f"{c.path}\0{c.physical_type}\0{c.logical_type}\0{c.converted_type}\0{c.length}" for c in columns)
        return hashlib.sha256("\n".join(spelled).encode()).hexdigest()

    return signature


def footer_signatures(files: DataFrame) -> DataFrame:
    """path, signature of every file of ``files`` (path); null for a file that
    could not be opened here."""
    signature = footer_reader()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def one(path: str) -> str | None:
            try:
                return signature(path)
            except (OSError, ValueError, ImportError):  # another store, or no Parquet file: Spark will tell
                return None

        with ThreadPoolExecutor(8) as pool:  # opening a footer is waiting, not work
            for batch in batches:
                found = pool.map(one, batch.column("path").to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(list(found), pa.string())], ["path", "signature"])

    return files.select("path").mapInArrow(run, "path string, signature string")


def _told_by_spark(spark: SparkSession, paths: list[str]) -> list[SchemaGroup]:
    groups: dict[str, list[str]] = {}
    with ThreadPoolExecutor(16) as pool:
        for path, schema in zip(paths, pool.map(lambda p: spark.read.parquet(p).schema.json(), paths), strict=True):
            groups.setdefault(schema, []).append(path)
    return [SchemaGroup(schema, found) for schema, found in groups.items()]


def _grouped(spark: SparkSession, found: list[tuple[str | None, str]]) -> list[SchemaGroup]:
    groups: dict[str, list[str]] = {}
    for mark, path in found:
        if mark is not None:
            groups.setdefault(mark, []).append(path)
    unopened = [path for mark, path in found if mark is None]
    return [SchemaGroup(mark, paths) for mark, paths in groups.items()] + _told_by_spark(spark, unopened)


def group_files(spark: SparkSession, paths: list[str]) -> list[SchemaGroup]:
    """The given files by schema, in the order in which schemas first occur."""
    if not paths:
        return []
    files = spark.createDataFrame([(p,) for p in paths], "path string")
    marks = {r["path"]: r["signature"] for r in footer_signatures(files).collect()}
    return _grouped(spark, [(marks[p], p) for p in paths])


def group_directories(spark: SparkSession, directories: list[str]) -> list[SchemaGroup]:
    """The given directories of Parquet files by schema. A directory whose files
    agree stays one path; the files of one that holds several schemas are listed,
    so the driver sees file names of such directories only."""
    if not directories:
        return []
    listed = spark.read.format("binaryFile").load(directories).select("path")
    marked = footer_signatures(listed).withColumn("directory", F.regexp_replace("path", "/[^/]*$", ""))
    mark = F.coalesce("signature", F.lit(""))
    by_directory = marked.groupBy("directory").agg(
        F.collect_set(mark).alias("marks"), F.collect_list(F.struct("signature", "path")).alias("files")
    )
    mixed = (F.size("marks") > 1) | F.array_contains("marks", "")
    rows = by_directory.select("directory", "marks", F.when(mixed, F.array_sort("files")).alias("files")).collect()
    found: list[tuple[str | None, str]] = []
    for r in sorted(rows, key=lambda r: r["directory"]):
        found += [(f["signature"], f["path"]) for f in r["files"]] if r["files"] is not None else [(r["marks"][0], r["directory"])]
    return _grouped(spark, found)
