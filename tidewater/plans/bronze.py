"""Landing → Bronze (+ quarantine): one job over all pending landing files.

Plan per run, independent of the number of files or months:

1. list landing files through Spark and validate every name (no write yet);
2. pending months = landed months less done months (Bronze's directories, and
   months logged to have had no valid rows); the first file of a month counts,
   others and files of done months are skipped;
3. read the pending files in one scan when their schemas merge, else one scan
   per footer schema; normalise each to the Bronze layout and ``unionByName``;
4. claim the pending months, so that no other run works on them; write the
   quarantine and Bronze beside their tables, counting rows in the writes; then
   put the new months in place, quarantine first, and write the run-log. A failed
   write leaves the tables as they were, and a month is done once Bronze holds it.

Each landing file is scanned twice (quarantine and Bronze writes). The Bronze
pass's ``IS NOT NULL`` checks on same-typed source columns reach the Parquet
reader; the quarantine predicate cannot (a ``try_cast`` to a narrower type may
turn a value into NULL), so that pass reads every row once.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.dedup import ROW_ID, duplicate_rows, mark_duplicates, unique_rows
from tidewater.operators.normalize import normalize_trips
from tidewater.operators.split import (
    bronze_projection,
    quarantine_projection,
    schema_violations,
    valid_rows,
)
from tidewater.plans.claims import claimed
from tidewater.plans.common import (
    LakePaths,
    batch_timestamp,
    logger,
    new_batch_id,
    stage_state,
)
from tidewater.schemas import DUPLICATE_REASON, FAILURE_DUPLICATE
from tidewater.session import ensure_checkpoint_dir
from tidewater.sinks.publish import publish, recover, stage_months
from tidewater.sinks.writers import log_run
from tidewater.sources.landing import (
    LandingFile,
    list_landing_files,
    one_per_month,
    read_landing,
)
from tidewater.sources.tables import drop_periods, period_dirs

STAGE = "bronze"


@dataclass
class IngestResult:
    batch_id: str
    landing_files: int
    files_skipped: int
    records_processed: int = 0
    schema_violations: int = 0
    duplicates: int = 0
    periods: list[tuple[int, int]] = field(default_factory=list)
    busy: list[tuple[int, int]] = field(default_factory=list)
    job_duration_sec: float = 0.0


def normalized_landing(
    spark: SparkSession,
    files: list[LandingFile],
    batch_id: str,
    ingested_at: Column | None = None,
) -> DataFrame:
    """All rows of ``files`` in the Bronze layout (+ reason and ``_row_id``):
    one scan when the file schemas merge, else one per distinct schema."""
    stamp = ingested_at if ingested_at is not None else batch_timestamp()
    frames = [
        normalize_trips(
            scan,
            period_year=F.col("_period_year"),
            period_month=F.col("_period_month"),
            source_file=F.col("_source_file"),
            batch_id=batch_id,
            ingested_at=stamp,
            carry=[ROW_ID],
        )
        for scan in read_landing(spark, files)
    ]
    return reduce(lambda a, b: a.unionByName(b), frames)


def pending_files(
    spark: SparkSession, files: list[LandingFile], paths: LakePaths, force: bool = False
) -> list[LandingFile]:
    """The first file of every month that is not done yet, or with ``force`` of
    every month."""
    done = set() if force else stage_state(spark, paths, STAGE, paths.bronze).done
    return [f for f in one_per_month(files) if (f.year, f.month) not in done]


def ingest(
    spark: SparkSession,
    paths: LakePaths,
    batch_id: str | None = None,
    dedup: bool = False,
    layout: str = "scan",
    force: bool = False,
) -> IngestResult:
    """Ingest every pending landing file into Bronze and quarantine.

    Raises ``FileNotFoundError`` when the landing directory has no trip
    files and ``ValueError`` for a file name without a period, before any
    write. A month that Bronze holds, or that is logged to have had no valid
    rows, is skipped unless ``force`` is set. With ``dedup`` the valid rows are
    also checked for duplicate business keys within their month; copies go to
    ``quarantine/duplicate_records``.
    """
    files = list_landing_files(spark, paths.landing)
    return ingest_files(spark, files, paths, batch_id=batch_id, dedup=dedup, layout=layout, force=force)


def ingest_files(
    spark: SparkSession,
    files: list[LandingFile],
    paths: LakePaths,
    batch_id: str | None = None,
    dedup: bool = False,
    layout: str = "scan",
    force: bool = False,
) -> IngestResult:
    """Ingest the given landing files. Of several files for one month the first
    by path counts; the others, and files of done months, are skipped. Months that
    another run is ingesting are left to it and reported in ``busy``."""
    start = time.time()
    active_batch = batch_id or new_batch_id()
    result = IngestResult(active_batch, len(files), len(files))
    wanted = sorted((f.year, f.month) for f in pending_files(spark, files, paths, force))
    logger.info("ingest start batch=%s files=%d pending=%d", active_batch, len(files), len(wanted))
    if wanted:
        with claimed(spark, paths, STAGE, wanted, active_batch) as mine:
            result.busy = sorted(set(wanted) - set(mine))
            for root in (paths.bronze, paths.schema_violations, paths.duplicate_records):
                recover(spark, root, mine)
            # a run that held them before may have finished some
            todo = [f for f in pending_files(spark, files, paths, force) if (f.year, f.month) in mine]
            if todo:
                _ingest_claimed(spark, todo, paths, result, dedup, layout)
    result.job_duration_sec = time.time() - start
    logger.info(
        "ingest done batch=%s clean=%d violations=%d duplicates=%d skipped=%d",
        active_batch,
        result.records_processed,
        result.schema_violations,
        result.duplicates,
        result.files_skipped,
    )
    return result


def _ingest_claimed(
    spark: SparkSession, todo: list[LandingFile], paths: LakePaths, result: IngestResult, dedup: bool, layout: str
) -> None:
    periods = sorted((f.year, f.month) for f in todo)
    normalized = normalized_landing(spark, todo, result.batch_id)
    # rejects are few: one file a month, not one a scan task
    rejected = stage_months(schema_violations(normalized), paths.schema_violations, periods, layout="rebalance")
    staged = [rejected]

    valid = valid_rows(normalized)
    if dedup:
        base = ensure_checkpoint_dir(spark, paths.checkpoint_fallback)
        repeated_root = f"{base.rstrip('/')}/repeated-{result.batch_id}"

        def stored(repeated: DataFrame) -> DataFrame:
            repeated.write.mode("overwrite").parquet(repeated_root)
            return spark.read.schema(repeated.schema).parquet(repeated_root)

        marked = mark_duplicates(valid, materialize=stored)
        copies = quarantine_projection(duplicate_rows(marked), FAILURE_DUPLICATE, DUPLICATE_REASON)
        staged.append(stage_months(copies, paths.duplicate_records, periods, layout="rebalance"))
        valid = unique_rows(marked)
    else:  # copies that an earlier run with dedup found are now in Bronze again
        drop_periods(spark, paths.duplicate_records, period_dirs(spark, paths.duplicate_records) & set(periods))

    clean = stage_months(bronze_projection(valid), paths.bronze, periods, layout)
    for write in (*staged, clean):
        publish(spark, write)

    result.periods = periods
    result.files_skipped = result.landing_files - len(todo)
    result.records_processed = sum(clean.rows.values())
    result.schema_violations = sum(rejected.rows.values())
    result.duplicates = sum(sum(s.rows.values()) for s in staged[1:])
    counts = {p: (clean.rows[p], sum(s.rows[p] for s in staged)) for p in periods}
    log_run(spark, paths.run_log, STAGE, counts, result.batch_id)
