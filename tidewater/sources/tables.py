"""Readers for the lakehouse tables (Bronze, Silver, Gold, run-log) and the
zone lookup CSV."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from time import sleep

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions import resolve_source_columns, safe_value
from tidewater.operators.periods import period_filter
from tidewater.schemas import RUN_LOG_SCHEMA, ZONE_LOOKUP_SCHEMA
from tidewater.sources.footers import group_directories

_MISSING_MARKERS = ("PATH_NOT_FOUND", "Path does not exist", "UNABLE_TO_INFER_SCHEMA")


def _is_missing(exc: AnalysisException) -> bool:
    text = str(exc)
    return any(marker in text for marker in _MISSING_MARKERS)


def read_table(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame | None:
    """A partitioned Parquet table by its root, or ``None`` when the root is
    missing or holds no data files yet. ``year``/``month`` are discovered
    from the ``year=Y/month=M`` directories. A known ``schema`` skips the
    inference pass over file footers."""
    fs, path = file_system(spark, root)
    if not fs.exists(path(root)):  # a read that fails would be reported to all listeners
        return None
    try:
        reader = spark.read if schema is None else spark.read.schema(schema)
        frame = reader.parquet(root)
        frame.schema  # noqa: B018 - forces file listing / schema resolution
        return frame
    except AnalysisException as exc:
        if _is_missing(exc):
            return None
        raise


def read_periods(
    spark: SparkSession,
    root: str,
    periods: list[tuple[int, int]] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame | None:
    """Rows of the given periods only (``None``: the whole table).

    Only the directories of the wanted years × months are listed, through a
    glob under the table root (``basePath`` keeps ``year``/``month`` as
    partition columns); the exact period predicate then drops the other
    combinations of that cross product. Reading a few months of a large
    table therefore never lists the whole table. ``None`` when no wanted
    month has data.
    """
    if periods is None:
        return read_table(spark, root, schema)
    if not periods:
        return None
    base = root.rstrip("/")
    years = ",".join(str(y) for y in sorted({int(y) for y, _ in periods}))
    months = ",".join(str(m) for m in sorted({int(m) for _, m in periods}))
    reader = spark.read.option("basePath", base)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        frame = reader.parquet(f"{base}/year={{{years}}}/month={{{months}}}")
        frame.schema  # noqa: B018 - resolves the glob
    except AnalysisException as exc:
        if _is_missing(exc):
            return None
        raise
    return frame.filter(period_filter(periods))


def file_system(spark: SparkSession, root: str):
    """(Hadoop file system of ``root``, its Path class)."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return path(root).getFileSystem(conf), path


def _holds_data(fs, directory, looks: int = 3) -> bool:
    try:
        entries = fs.listStatusIterator(directory)
        while entries.hasNext():
            if not entries.next().getPath().getName().startswith(("_", ".")):
                return True
        return False
    except Py4JJavaError:  # a month that is just being replaced is back after a moment
        if looks == 1:
            raise
    if not fs.exists(directory):
        sleep(0.05)
    return fs.exists(directory) and _holds_data(fs, directory, looks - 1)


def period_dirs(spark: SparkSession, root: str) -> set[tuple[int, int]]:
    """Periods whose ``year=Y/month=M`` directory under ``root`` holds a data
    file. One glob and a look at each month's first entries: no file is opened,
    and the work grows with months, not with files."""
    fs, path = file_system(spark, root)
    found = set()
    for status in fs.globStatus(path(f"{root.rstrip('/')}/year=*/month=*")) or []:
        directory = status.getPath()
        parts = (directory.getParent().getName().split("=")[1], directory.getName().split("=")[1])
        if all(p.isdigit() for p in parts) and _holds_data(fs, directory):
            found.add((int(parts[0]), int(parts[1])))
    return found


def drop_periods(spark: SparkSession, root: str, periods: Iterable[tuple[int, int]]) -> None:
    """Delete the directories of ``periods`` under ``root``."""
    fs, path = file_system(spark, root)
    for year, month in periods:
        fs.delete(path(f"{root.rstrip('/')}/year={year}/month={month}"), True)


def is_merge_conflict(exc: Exception) -> bool:
    """Whether Spark refused to merge the files' schemas (it reports this as a
    plain JVM error, so it is told by its message)."""
    text = str(exc)
    return "CANNOT_MERGE_SCHEMA" in text or "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE" in text or "Failed to merge" in text


def read_resolved(
    spark: SparkSession,
    root: str,
    periods: list[tuple[int, int]],
    schema: T.StructType,
    absent: dict[str, object] | None = None,
) -> DataFrame | None:
    """Rows of ``periods`` in the columns of ``schema`` that the files have, by
    name, each cast to the schema's type where the stored type differs. Columns
    that no file has are left out. ``None`` when no wanted month has data.

    Every file counts with its own columns, also beside files of its month that
    lack them or store them as other types: files are grouped by schema in one job
    over their footers and each group is one scan. A column of ``absent`` takes the
    value given there in the rows of files that lack it; other files' NULLs stay.
    """
    base = root.rstrip("/")
    dirs = [f"{base}/year={y}/month={m}" for y, m in sorted(set(periods) & period_dirs(spark, root))]
    if not dirs:
        return None
    groups = group_directories(spark, dirs)
    scans = [spark.read.option("basePath", base).parquet(*group.paths) for group in groups]
    frames = [_cast_to(scan, schema, absent or {}) for scan in scans]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _cast_to(frame: DataFrame, schema: T.StructType, absent: dict[str, object]) -> DataFrame:
    available, types = resolve_source_columns(frame.columns), dict(frame.dtypes)
    columns = []
    for f in schema.fields:
        if f.name.lower() in available:
            columns.append(safe_value(available, f.name, f.dataType.simpleString(), types).alias(f.name))
        elif f.name in absent:
            columns.append(F.lit(absent[f.name]).cast(f.dataType).alias(f.name))
    return frame.select(*columns)


@dataclass(frozen=True)
class LogEntry:
    """What the run-log says of one stage and month."""

    rows_written: int | None
    batch_id: str | None
    source_batch_id: str | None


def run_log_summary(spark: SparkSession, root: str) -> dict[str, dict[tuple[int, int], LogEntry]]:
    """stage → {period: entry}; the log holds one row per stage and month."""
    log = read_table(spark, root, RUN_LOG_SCHEMA)
    if log is None:
        return {}
    summary: dict[str, dict[tuple[int, int], LogEntry]] = {}
    for r in log.collect():
        entry = LogEntry(r["rows_written"], r["batch_id"], r["source_batch_id"])
        summary.setdefault(r["stage"], {})[(int(r["year"]), int(r["month"]))] = entry
    return summary


def read_zone_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup CSV: its columns are found by the names in its header, in any
    order and beside others; the id is a number or NULL, an empty field NULL.
    ``ValueError`` if a needed column is absent."""
    raw = spark.read.option("header", "true").csv(path)  # header only: every column is text
    available = resolve_source_columns(raw.columns)
    absent = [f.name for f in ZONE_LOOKUP_SCHEMA.fields if f.name.lower() not in available]
    if absent:
        raise ValueError(f"zone lookup {path} lacks the columns {', '.join(absent)}")
    types = dict(raw.dtypes)
    return raw.select(
        *[
            safe_value(available, f.name, f.dataType.simpleString(), types).alias(f.name)
            for f in ZONE_LOOKUP_SCHEMA.fields
        ]
    )
