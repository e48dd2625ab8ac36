"""Replace months of a partitioned table without a time in which they are gone.

New months are written beside the table, under ``_staging/<token>`` of its root,
where readers do not look. Only when the whole write has succeeded are the month's
directories exchanged, by two renames each: the old directory goes to
``_replaced/<token>``, the new one takes its place, and what was replaced is
deleted at the end. A month that came out without rows only loses its old
directory. If the write fails, the table is as it was; if the driver is lost
between the two renames, :func:`recover` puts the old month back.

A rename is one metadata operation on HDFS and other file systems; a plain object
store copies instead, which takes longer and leaves the result the same.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tidewater.operators.periods import PERIOD
from tidewater.sinks.writers import counted, laid_out
from tidewater.sources.tables import file_system

STAGING, REPLACED = "_staging", "_replaced"


@dataclass
class Staged:
    """A finished write that no reader sees yet, and its rows per month."""

    root: str
    periods: list[tuple[int, int]]
    token: str = field(default_factory=lambda: uuid.uuid4().hex)
    rows: dict[tuple[int, int], int] = field(default_factory=dict)

    @property
    def path(self) -> str:
        return f"{self.root.rstrip('/')}/{STAGING}/{self.token}"


def stage_months(frame: DataFrame, root: str, periods: list[tuple[int, int]], layout: str = "scan") -> Staged:
    """Write ``frame`` (all of ``periods``) beside the table at ``root``. Rows are
    counted by month in the write itself."""
    staged = Staged(root, periods)
    frame, read_counts = counted(laid_out(frame, layout), len(periods))
    frame.write.partitionBy(*PERIOD).parquet(staged.path)
    staged.rows = dict.fromkeys(periods, 0) | read_counts()
    return staged


def _move(fs, source, target) -> None:
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise OSError(f"{source} could not be renamed to {target}")


def _drop_empty(fs, directory) -> None:
    if fs.exists(directory) and not fs.listStatus(directory):
        fs.delete(directory, False)


def publish(spark: SparkSession, staged: Staged) -> None:
    """Put the staged months in place of the table's own."""
    fs, path = file_system(spark, staged.root)
    base = staged.root.rstrip("/")
    replaced = f"{base}/{REPLACED}/{staged.token}"
    for year, month in staged.periods:
        part = f"year={year}/month={month}"
        current, new = path(f"{base}/{part}"), path(f"{staged.path}/{part}")
        if fs.exists(current):
            _move(fs, current, path(f"{replaced}/{part}"))
        if fs.exists(new):
            _move(fs, new, current)
    for done in (replaced, staged.path):
        fs.delete(path(done), True)
        _drop_empty(fs, path(done).getParent())


def _holds_months(fs, path, directory) -> bool:
    return bool(fs.globStatus(path(f"{directory}/year=*/month=*")))


def recover(
    spark: SparkSession, root: str, periods: Iterable[tuple[int, int]], hours: float = 24.0
) -> list[tuple[int, int]]:
    """Undo what a lost driver left of its exchange of ``periods``: a replaced
    month whose place is empty goes back, the rest is deleted, and so is what is
    left of a write that was broken off over ``hours`` ago. Returns the months put
    back. Only for months that no other run is working on."""
    fs, path = file_system(spark, root)
    base, back = root.rstrip("/"), []
    if not any(fs.exists(path(f"{base}/{area}")) for area in (STAGING, REPLACED)):
        return back
    for year, month in periods:
        part = f"year={year}/month={month}"
        for old in fs.globStatus(path(f"{base}/{REPLACED}/*/{part}")) or []:
            if not fs.exists(path(f"{base}/{part}")):
                _move(fs, old.getPath(), path(f"{base}/{part}"))
                back.append((year, month))
            else:
                fs.delete(old.getPath(), True)
        for new in fs.globStatus(path(f"{base}/{STAGING}/*/{part}")) or []:
            fs.delete(new.getPath(), True)
    for area in (STAGING, REPLACED):
        for left in fs.globStatus(path(f"{base}/{area}/*")) or []:
            writing = path(f"{left.getPath()}/_temporary")
            running = fs.exists(writing) and time.time() * 1000 - left.getModificationTime() < hours * 3_600_000
            if not running and not _holds_months(fs, path, left.getPath()):
                fs.delete(left.getPath(), True)
        _drop_empty(fs, path(f"{base}/{area}"))
    return back
