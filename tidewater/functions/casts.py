"""Tolerant source-to-target casts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def resolve_source_columns(columns: Iterable[str]) -> dict[str, str]:
    """Map lower-cased column names to the names present in a file.

    Names are matched case-insensitively, as Spark resolves them, so a file
    with ``Airport_fee`` feeds ``airport_fee``. Two columns that differ only in
    case are ambiguous and rejected.
    """
    resolved: dict[str, str] = {}
    for name in columns:
        key = name.lower()
        if key in resolved and resolved[key] != name:
            raise ValueError(
                f"ambiguous source columns {resolved[key]!r} and {name!r} differ only in case"
            )
        resolved[key] = name
    return resolved


def typed_null(data_type: str) -> Column:
    return F.lit(None).cast(data_type)


_INTEGRAL = ("int", "bigint", "smallint", "tinyint")


def safe_value(
    available: dict[str, str],
    source: str | None,
    data_type: str,
    source_types: dict[str, str] | None = None,
) -> Column:
    """Source column cast to ``data_type``, or a typed NULL when it is absent.

    ``try_cast`` keeps ANSI mode from failing the job on a malformed value: it
    becomes NULL, and a NULL required column sends the row to quarantine.
    Fractions are truncated toward zero for integer targets, from numbers
    (1.9 → 1) and from numeric text ('1.9' → 1) alike; text goes through a
    decimal for that, since a direct text-to-int cast rejects a fraction.
    A cast to the column's own type is removed by the optimizer, so filters on
    such columns still reach the Parquet reader.
    """
    if source is None or source.lower() not in available:
        return typed_null(data_type)
    name = available[source.lower()]
    column = F.col(f"`{name}`")
    if data_type in _INTEGRAL and (source_types or {}).get(name) == "string":
        column = F.trim(column).try_cast("decimal(38,9)")
    return column.try_cast(data_type)
