"""Zone dimension and the fact ⟕ zone join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.schemas import PICKUP_ZONE_RENAMES, ZONE_RENAMES


def zone_dimension(lookup: DataFrame) -> DataFrame:
    """Lookup (LocationID, Borough, Zone, service_zone) → snake_case dimension."""
    return lookup.select(*[F.col(src).alias(dst) for src, dst in ZONE_RENAMES.items()])


def with_pickup_zone(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """fact LEFT JOIN dim ON pulocationid = location_id.

    Dimension columns are renamed with a ``pickup_`` prefix and the key is
    dropped; an unmatched pickup zone keeps its fact row with NULL zone
    columns. Drop-off zones are not joined. Spark broadcasts the dimension by
    its size in bytes (``spark.sql.autoBroadcastJoinThreshold``), or joins by
    sort and merge and splits hot locations.
    """
    zones = dim.withColumnsRenamed(PICKUP_ZONE_RENAMES)
    return fact.join(zones, F.col("pulocationid") == F.col("location_id"), "left").drop("location_id")
