"""Place of every row in the order of its group, for groups of any size.

Rows are dealt by ranges of (group, order) and sorted within each partition, so a
group that holds a third of all rows is spread over partitions like any other.
Rows get consecutive numbers partition by partition; the first number and the
count of each (group, partition) are a small table whose running sum turns these
numbers into places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewater.llm.common import written

#: ``monotonically_increasing_id`` puts the partition above this bit.
PART = 33


def with_positions(frame: DataFrame, group: str, order: list[Column], path: str) -> DataFrame:
    """``frame`` with ``position``, from 0 in each ``group`` by ``order``, and
    ``group_rows``. Null is a group like any other. Rows that are equal in group
    and order take their places in any order; those alike in every column are not
    told apart. Written under ``path``: an executor lost later leaves the numbers
    as they are."""
    keys = [F.col(group).asc_nulls_first(), *order]
    # rows alike in all keys may be many: the last key deals them out as well
    spread = frame.withColumn("__salt", F.monotonically_increasing_id())
    dealt = spread.repartitionByRange(*keys, F.col("__salt")).sortWithinPartitions(*keys).drop("__salt")
    numbered = written(dealt.withColumn("__at", F.monotonically_increasing_id()), f"{path}/numbered")
    part = F.shiftright("__at", PART)
    starts = numbered.groupBy(F.col(group).alias("__group"), part.alias("__part")).agg(
        F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n")
    )
    same = W.partitionBy("__group")
    before = F.sum("__n").over(same.orderBy("__part").rowsBetween(W.unboundedPreceding, -1))
    starts = written(
        starts.select(
            "__group", "__part", (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__shift"),
            F.sum("__n").over(same).alias("group_rows"),
        ), f"{path}/starts",
    )
    joined = numbered.join(starts, numbered[group].eqNullSafe(starts["__group"]) & (part == starts["__part"]))
    return joined.withColumn("position", F.col("__at") + F.col("__shift")).select(*frame.columns, "position", "group_rows")
