"""Shared pieces of the stage jobs: paths, batch ids, stage state, counts."""

from __future__ import annotations

import logging
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewater.operators.periods import PERIOD
from tidewater.sources.tables import period_dirs, read_periods, run_log_summary

logger = logging.getLogger("tidewater")


@dataclass(frozen=True)
class LakePaths:
    """Table roots of one lakehouse (any Hadoop-compatible URI).

    The quarantine and the run-log live *beside* Bronze, not inside it, so
    no overwrite of one table can touch another.
    """

    landing: str
    bronze: str
    quarantine: str
    silver: str
    gold: str
    run_log: str
    lookup: str | None = None
    checkpoints: str | None = None

    @classmethod
    def under(cls, root: str, lookup: str | None = None) -> "LakePaths":
        root = root.rstrip("/")
        return cls(
            landing=f"{root}/landing/trip",
            bronze=f"{root}/bronze/trip",
            quarantine=f"{root}/quarantine/trip",
            silver=f"{root}/silver/trip",
            gold=f"{root}/gold",
            run_log=f"{root}/_run_log",
            lookup=lookup if lookup is not None else f"{root}/reference/taxi_zone_lookup.csv",
            checkpoints=f"{root}/_checkpoints",
        )

    @property
    def checkpoint_fallback(self) -> str:
        """Shared folder for ``checkpoint()`` when the session names none
        (``spark.checkpoint.dir`` always wins): beside the run-log, on the
        same shared storage as the tables."""
        return self.checkpoints or f"{self.run_log.rstrip('/')}_checkpoints"

    @property
    def claims(self) -> str:
        """Where runs mark the months that they are working on."""
        return f"{self.run_log.rstrip('/')}_claims"

    @property
    def schema_violations(self) -> str:
        return f"{self.quarantine}/schema_violations"

    @property
    def duplicate_records(self) -> str:
        return f"{self.quarantine}/duplicate_records"

    @property
    def fact(self) -> str:
        return f"{self.gold}/fact_trip_summary"

    @property
    def dim_zone(self) -> str:
        return f"{self.gold}/dim_taxi_zone"


def new_batch_id(prefix: str = "") -> str:
    """``[prefix]YYYYmmddTHHMMSSZ-xxxxxxxx`` in UTC."""
    now = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%SZ")
    return f"{prefix}{now}-{uuid.uuid4().hex[:8]}"


def batch_timestamp() -> Column:
    """One audit timestamp per batch, taken on the driver, so every table a
    batch writes carries the same value."""
    return F.lit(datetime.now(timezone.utc)).cast("timestamp")


@dataclass(frozen=True)
class StageState:
    """Periods of one stage: ``source`` holds data to read, ``stored`` holds
    this stage's data, ``done`` needs no work; ``source_batches`` names the
    batch that wrote each source period, where known."""

    source: set[tuple[int, int]]
    stored: set[tuple[int, int]]
    done: set[tuple[int, int]]
    source_batches: dict[tuple[int, int], str | None]


def stage_state(
    spark: SparkSession,
    paths: LakePaths,
    stage: str,
    root: str,
    source_stage: str | None = None,
    source_root: str | None = None,
) -> StageState:
    """What there is to do for ``stage``, from the table directories.

    A month holds data if its directory holds a data file, whoever wrote it:
    tables restored without their log, or written by another tool, count, and a
    removed month is to be done again. The run-log adds what directories cannot
    show: months that were processed and produced no rows are done too, and a
    month that was made from another batch than the source month now holds is
    not.
    """
    log = run_log_summary(spark, paths.run_log)
    mine, theirs = log.get(stage, {}), log.get(source_stage or "", {})
    source = period_dirs(spark, source_root) if source_root else set()
    stored = period_dirs(spark, root)
    done = stored | {p for p, entry in mine.items() if entry.rows_written == 0}
    outdated = {
        p
        for p, entry in mine.items()
        if entry.source_batch_id and p in theirs and theirs[p].batch_id != entry.source_batch_id
    }
    return StageState(source, stored, done - outdated, {p: entry.batch_id for p, entry in theirs.items()})


def table_counts(
    spark: SparkSession,
    tables: dict[str, tuple[str, StructType]],
    periods: list[tuple[int, int]],
) -> dict[str, dict[tuple[int, int], int]]:
    """name → {period: rows} of several written tables (0 for periods without
    rows), in one job over all of them.

    Only row counts are needed, which Parquet keeps in its footers, so no
    column data is decoded; the result has one entry per table and month.
    """
    counts = {name: dict.fromkeys(periods, 0) for name in tables}
    frames = []
    for name, (root, schema) in tables.items():
        frame = read_periods(spark, root, periods, schema)
        if frame is not None:
            frames.append(frame.select(F.lit(name).alias("name"), *PERIOD))
    if frames:
        together = reduce(lambda a, b: a.unionAll(b), frames)
        for r in together.groupBy("name", *PERIOD).count().collect():
            counts[r["name"]][(int(r["year"]), int(r["month"]))] = int(r["count"])
    return counts
