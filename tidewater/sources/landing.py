"""Landing zone: discover monthly trip files, parse their period, read them.

Files of different months drift in schema (bigint vs double counts,
``timestamp`` vs ``timestamp_ntz``, ``airport_fee`` vs ``Airport_fee``).
The common case — one schema, or schemas that only add or drop columns — is
read as one scan with ``mergeSchema`` (all footers are read in one parallel
job). When the schemas conflict (``mergeSchema`` rejects int/double or
timestamp/timestamp_ntz), files are grouped by their footer schema, in one more
job over the footers, and each group is read in one scan; the caller normalises each scan to the Bronze
layout and unions them. Either way: one job over all pending files instead of
a loop per file.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators.dedup import file_row_id
from tidewater.schemas import LANDING_GLOB, LANDING_PATTERN
from tidewater.sources.footers import group_files
from tidewater.sources.tables import is_merge_conflict

_PATTERN = re.compile(LANDING_PATTERN)


@dataclass(frozen=True)
class LandingFile:
    path: str
    year: int
    month: int

    @property
    def name(self) -> str:
        return self.path.rstrip("/").rsplit("/", 1)[-1]


def parse_period(name: str) -> tuple[int, int]:
    """(year, month) of a landing file, from its whole name
    (``yellow_tripdata_YYYY-MM.parquet``). ``ValueError`` for any other name
    and for a month outside 1 to 12."""
    found = _PATTERN.fullmatch(name)
    year, month = map(int, found.groups()) if found else (0, 0)
    if not 1 <= month <= 12:
        raise ValueError(f"{name}: not a monthly landing file name (yellow_tripdata_YYYY-MM.parquet)")
    return year, month


def one_per_month(files: list[LandingFile]) -> list[LandingFile]:
    """The first file, by path, of every month."""
    first: dict[tuple[int, int], LandingFile] = {}
    for f in sorted(files, key=lambda f: f.path):
        first.setdefault((f.year, f.month), f)
    return list(first.values())


def list_landing_files(spark: SparkSession, landing_dir: str) -> list[LandingFile]:
    """Top-level ``yellow_tripdata_*.parquet`` files of ``landing_dir``, sorted.

    Listing goes through Spark's file index (any Hadoop filesystem); only
    path metadata is selected, file contents are not read. Every name is
    validated before anything is written: one bad name fails the run.
    """
    try:
        listed = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", LANDING_GLOB)
            .option("recursiveFileLookup", "false")
            .load(landing_dir)
            .select("path")
            .collect()
        )
    except AnalysisException as exc:  # missing directory
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            listed = []
        else:
            raise
    files = []
    for row in sorted(listed, key=lambda r: r.path):
        year, month = parse_period(row.path.rsplit("/", 1)[-1])
        files.append(LandingFile(row.path, year, month))
    if not files:
        raise FileNotFoundError(f"{landing_dir} holds no monthly landing file ({LANDING_GLOB})")
    return files


def group_by_schema(spark: SparkSession, files: list[LandingFile]) -> list[tuple[T.StructType, list[LandingFile]]]:
    """Files by their Parquet schema, found by one job over all footers; each
    group's schema is read from its first file."""
    by_path = {f.path: f for f in files}
    groups = group_files(spark, list(by_path))
    return [(spark.read.parquet(g.paths[0]).schema, [by_path[p] for p in g.paths]) for g in groups]


def read_group(spark: SparkSession, schema: T.StructType, files: list[LandingFile]) -> DataFrame:
    """One scan over files that share ``schema``, with file-derived columns."""
    return with_file_columns(spark.read.schema(schema).parquet(*[f.path for f in files]))


def read_landing(spark: SparkSession, files: list[LandingFile]) -> list[DataFrame]:
    """Scans covering ``files``: one merged scan when the schemas merge,
    otherwise one scan per distinct footer schema."""
    try:
        merged = spark.read.option("mergeSchema", "true").parquet(*[f.path for f in files])
        merged.schema  # noqa: B018 - runs the footer merge
        return [with_file_columns(merged)]
    except Exception as exc:  # noqa: BLE001 - a merge conflict arrives as a raw JVM error
        if not is_merge_conflict(exc):
            raise
    return [read_group(spark, schema, group) for schema, group in group_by_schema(spark, files)]


def with_file_columns(frame: DataFrame) -> DataFrame:
    """``_source_file``, ``_period_year``, ``_period_month`` (from the file
    name) and ``_row_id`` (row index in the file)."""
    name = F.col("_metadata.file_name")
    return frame.withColumns(
        {
            "_source_file": F.col("_metadata.file_path"),
            "_period_year": F.regexp_extract(name, LANDING_PATTERN, 1).cast("int"),
            "_period_month": F.regexp_extract(name, LANDING_PATTERN, 2).cast("int"),
            # unique within a period: one landing file per period
            "_row_id": file_row_id(),
        }
    )
