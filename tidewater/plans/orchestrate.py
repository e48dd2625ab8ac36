"""Run the three stages in order, with per-run overrides.

``batch_id`` is the ingest batch; the Silver and Gold stages mint their own
(``silver-…``, ``gold-…``). ``year``/``month`` select the Gold recompute (and,
when ``silver_period`` is set, the Silver month too); both must be given to
select a month, otherwise every month is taken. Blank strings and the text
``"None"`` count as unset, so values from templated schedulers pass through.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from time import sleep
from typing import Any, TypeVar

from pyspark.sql import SparkSession

from tidewater.plans import bronze, gold, silver
from tidewater.plans.common import LakePaths, logger

T = TypeVar("T")


def optional_int(value: Any) -> int | None:
    if value is None:
        return None
    text = str(value).strip()
    if text == "" or text == "None":
        return None
    return int(text)


def optional_str(value: Any) -> str | None:
    if value is None:
        return None
    text = str(value).strip()
    return None if text in ("", "None") else text


@dataclass
class RunConfig:
    paths: LakePaths
    batch_id: str | None = None
    year: int | None = None
    month: int | None = None
    silver_period: bool = False
    dedup: bool = False
    only_changed_gold: bool = False
    force: bool = False
    retries: int = 1
    retry_delay_sec: float = 300.0

    @classmethod
    def from_strings(cls, paths: LakePaths, **values: Any) -> "RunConfig":
        return cls(
            paths=paths,
            batch_id=optional_str(values.get("batch_id")),
            year=optional_int(values.get("year")),
            month=optional_int(values.get("month")),
            silver_period=bool(values.get("silver_period", False)),
            dedup=bool(values.get("dedup", False)),
            only_changed_gold=bool(values.get("only_changed_gold", False)),
            force=bool(values.get("force", False)),
        )


def attempted(name: str, stage: Callable[[], T], retries: int, delay_sec: float) -> T:
    """``stage()``, tried again up to ``retries`` times after an error.

    Stages read the tables' state when they start and leave the tables as they
    were when they fail, so another attempt does what is left to do. An error that
    names a wrong input (a bad file name, no landing files, a faulty lookup) would
    come back and is raised at once.
    """
    for attempt in range(retries + 1):
        try:
            return stage()
        except (ValueError, FileNotFoundError):
            raise
        except Exception as exc:  # noqa: BLE001 - whatever failed, the next attempt starts from the tables
            if attempt == retries:
                raise
            logger.warning("%s failed (%s); attempt %d of %d in %.0f s", name, exc, attempt + 2, retries + 1, delay_sec)
            sleep(delay_sec)
    raise AssertionError("unreachable")


def run(spark: SparkSession, cfg: RunConfig) -> dict[str, Any]:
    """The three stages in order, each tried again when it fails."""
    year, month = (cfg.year, cfg.month) if cfg.silver_period else (None, None)
    stages = {
        "ingest": lambda: bronze.ingest(spark, cfg.paths, batch_id=cfg.batch_id, dedup=cfg.dedup, force=cfg.force),
        "silver": lambda: silver.transform(spark, cfg.paths, year=year, month=month, force=cfg.force),
        "gold": lambda: gold.transform(spark, cfg.paths, year=cfg.year, month=cfg.month, only_changed=cfg.only_changed_gold),
    }
    return {name: attempted(name, stage, cfg.retries, cfg.retry_delay_sec) for name, stage in stages.items()}
