"""tidewater: a Spark-native trip-record lakehouse.

Landing Parquet → Bronze (+ quarantine) → Silver → Gold star schema → reports,
each stage a set-based DataFrame job over all pending months::

    import tidewater as tw

    paths = tw.LakePaths.under("s3a://bucket/lake")
    tw.run(spark, tw.RunConfig(paths=paths))
    fact, dim = tw.reports.load_gold(spark, paths)
    tw.reports.borough_ranking(fact, dim, year=1998).show()
"""

from tidewater.plans import bronze, gold, reports, silver
from tidewater.plans.common import LakePaths
from tidewater.plans.orchestrate import RunConfig, run

__version__ = "0.1.0"

__all__ = ["LakePaths", "RunConfig", "bronze", "gold", "reports", "run", "silver"]
