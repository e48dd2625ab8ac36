"""Landing files for tests and the bench, on a local file system."""

from __future__ import annotations

import glob
import os
import shutil

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidewater.sources.fixtures import landing_trips


def stage_landing_files(spark: SparkSession, sf_dir: str, landing_dir: str, scratch_dir: str) -> list[str]:
    """Write the fixture trips as monthly landing files
    ``yellow_tripdata_YYYY-MM.parquet`` (one file per month) on a local
    filesystem, for tests and the bench.

    Spark writes one directory per month with a single part file (all rows of
    a month are in one task after ``repartition``); each part file is then
    copied under its landing name.
    """
    trips = landing_trips(spark, sf_dir).withColumn("_period", F.date_format("shipdate", "yyyy-MM"))
    trips.drop("shipdate").repartition("_period").write.mode("overwrite").partitionBy("_period").parquet(
        scratch_dir
    )
    os.makedirs(landing_dir, exist_ok=True)
    written = []
    for part_dir in sorted(glob.glob(os.path.join(scratch_dir, "_period=*"))):
        period = part_dir.rsplit("=", 1)[-1]
        parts = glob.glob(os.path.join(part_dir, "part-*.parquet"))
        if len(parts) != 1:
            raise RuntimeError(f"expected one part file in {part_dir}, found {len(parts)}")
        target = os.path.join(landing_dir, f"yellow_tripdata_{period}.parquet")
        shutil.copyfile(parts[0], target)
        written.append(target)
    return written
