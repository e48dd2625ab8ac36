"""One run at a time for each stage and month.

A run that is about to work on months creates one small file for each,
``<claims>/<stage>/year=Y-month=M``, with the file system's put-if-absent
(``create`` without overwrite). Months whose file another run holds are left to
that run. The files are removed at the end; those of a run that was lost expire
after ``hours`` and are then taken over.

HDFS and other file systems create a file for one caller only. An object store
without conditional writes may let two runs through that start within the same
moment; each still publishes whole months, so the later one replaces the earlier.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from tidewater.plans.common import LakePaths, logger
from tidewater.sources.tables import file_system

CLAIM_HOURS = 24.0


def _create(fs, target, owner: str) -> bool:
    try:
        out = fs.create(target, False)
    except Py4JJavaError as exc:
        if "AlreadyExists" in exc.java_exception.getClass().getName() or fs.exists(target):
            return False
        raise
    out.write(bytearray(owner, "utf-8"))
    out.close()
    return True


def _expired(fs, target, hours: float) -> bool:
    if not fs.exists(target):
        return True  # released since
    return time.time() * 1000 - fs.getFileStatus(target).getModificationTime() > hours * 3_600_000


@contextmanager
def claimed(
    spark: SparkSession, paths: LakePaths, stage: str, periods: list[tuple[int, int]], owner: str, hours: float | None = None
) -> Iterator[list[tuple[int, int]]]:
    """The months of ``periods`` that this run alone may work on. State read
    before the claim may be outdated: read it again inside."""
    hours = CLAIM_HOURS if hours is None else hours
    fs, path = file_system(spark, paths.claims)
    mine: dict[tuple[int, int], object] = {}
    try:
        for year, month in periods:
            target = path(f"{paths.claims}/{stage}/year={year}-month={month}")
            got = _create(fs, target, owner)
            if not got and _expired(fs, target, hours):
                # of several that find it expired, one renames it away
                away = path(f"{paths.claims}/{stage}/_expired-{owner}-{year}-{month}")
                fs.rename(target, away)
                fs.delete(away, False)
                got = _create(fs, target, owner)
            if got:
                mine[(year, month)] = target
            else:
                logger.warning("%s: year=%d/month=%d is being done by another run", stage, year, month)
        yield list(mine)
    finally:
        for target in mine.values():
            fs.delete(target, False)
