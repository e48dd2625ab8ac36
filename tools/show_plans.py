"""Write PLANS.md: the physical plans of every stage and report, built on a
lakehouse staged from the test tables.  python tools/show_plans.py [sf_dir]"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewater.operators.dedup import mark_duplicates, unique_rows  # noqa: E402
from tidewater.operators.split import bronze_projection, bronze_rows, schema_violations, valid_rows  # noqa: E402
from tidewater.plans import bronze, gold, reports, silver  # noqa: E402
from tidewater.plans.common import LakePaths  # noqa: E402
from tidewater.schemas import BRONZE_SCHEMA, SILVER_SCHEMA  # noqa: E402
from tidewater.session import local_session  # noqa: E402
from tidewater.sources.fixtures import zone_lookup  # noqa: E402
from tools.staging import stage_landing_files  # noqa: E402
from tidewater.sources.landing import list_landing_files  # noqa: E402
from tidewater.sources.tables import read_periods, read_resolved  # noqa: E402


def plan(frame, mode: str = "simple") -> str:
    buffer = io.StringIO()
    with contextlib.redirect_stdout(buffer):
        frame.explain(mode=mode)
    return buffer.getvalue().strip()


def write_plans(spark, roots: dict[str, str]) -> list[tuple[str, str]]:
    """(title, executed plan) of the last write to each table, as Spark ran it."""
    runs = spark._jsparkSession.sharedState().statusStore().executionsList()
    found = {}
    for k in range(runs.size()):
        text = runs.apply(k).physicalPlanDescription()
        for title, root in roots.items():
            # months are written beside the table and put in place afterwards
            target = re.search(f"file:{re.escape(root)}(/_staging/[0-9a-f]+)?,", text)
            if "InsertIntoHadoopFsRelationCommand" in text and target:
                found[title] = re.sub("/_staging/[0-9a-f]+", "/_staging/<token>", text)
    return [(f"Write as run: {title}", found[title]) for title in roots if title in found]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    scratch = tempfile.mkdtemp(prefix="tidewater-plans-")
    spark = local_session(8)
    paths = LakePaths.under(os.path.join(scratch, "lake"))
    stage_landing_files(spark, sf_dir, paths.landing, os.path.join(scratch, "staging"))
    os.makedirs(os.path.dirname(paths.lookup), exist_ok=True)
    zone_lookup(spark, sf_dir).toPandas().to_csv(paths.lookup, index=False)
    files = list_landing_files(spark, paths.landing)
    normalized = bronze.normalized_landing(spark, files, "b")
    bronze.ingest(spark, paths)
    silver.transform(spark, paths)
    gold.transform(spark, paths)
    fact, dim = reports.load_gold(spark, paths)
    pending = [(1998, 3), (1998, 4)]

    def stored(repeated):
        repeated.write.parquet(os.path.join(scratch, "repeated"))
        return spark.read.parquet(os.path.join(scratch, "repeated"))

    sections = [
        ("Ingest: quarantine write input (all landing files, one merged scan)", schema_violations(normalized)),
        ("Ingest: Bronze write input", bronze_rows(normalized)),
        ("Ingest with dedup: Bronze input (repeated keys by hash aggregate, stored; full rows are not shuffled)",
         bronze_projection(unique_rows(mark_duplicates(valid_rows(normalized), materialize=stored)))),
        ("Silver: two pending months (glob-listed, rules pushed to the scan, no exchange)",
         silver.build_silver(read_resolved(spark, paths.bronze, pending, BRONZE_SCHEMA), "b")),
        ("Gold: fact (partial → final aggregate, rebalance of the aggregated rows)",
         gold.build_fact(read_periods(spark, paths.silver, pending, SILVER_SCHEMA), "g").hint("rebalance", "year", "month")),
        ("Report: KPIs 1998 (fact only, year partition filter)", reports.kpis(fact, 1998)),
        ("Report: borough ranking 1998 (pre-aggregated, dimension broadcast by its size)",
         reports.borough_ranking(fact, dim, 1998)),
        ("Report: trend by borough 1998", reports.trend(fact, dim, 1998, "pickup_borough")),
        ("Report: hourly profile 1998", reports.hourly_profile(fact, 1998)),
        ("Report: KPIs of the newest year (literal from the fact's directories)",
         reports.kpis(fact, reports.newest_year(spark, paths))),
    ]
    out = ["# Physical plans", "",
           f"Generated by `tools/show_plans.py` on a lakehouse staged from `{sf_dir}` (local[8]).",
           "Scratch paths are shown as `<lake>`.", ""]
    tables = {"quarantine": paths.schema_violations, "Bronze": paths.bronze, "Silver": paths.silver, "fact": paths.fact}
    texts = [(title, plan(frame, "formatted")) for title, frame in sections] + write_plans(spark, tables)
    for title, text in texts:
        text = text.replace(os.path.join(scratch, "lake"), "<lake>")
        keep = []
        for line in text.splitlines():
            if line.startswith(("Output", "Input", "Arguments", "Results", "Aggregate Attributes")):
                continue
            keep.append(line[:300])
        out += [f"## {title}", "", "```", *keep, "```", ""]
    spark.stop()
    target = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(target, "w") as handle:
        handle.write("\n".join(out))
    print(target)


if __name__ == "__main__":
    main()
