"""Wall time of the headline queries; prints one JSON line.

Tables are read from BENCH_SF_DIR on local[BENCH_CPUS]. Each has one file with one row group, which one task would read whole; they
are laid out in several files first, as tables of any size are, outside the timing. Every query runs from these; nothing is
cached between queries, only the JVM is warmed up once on the smallest tables. ``refresh_landed_sec`` is the rebuild of the
warehouse alone, from files landed outside the timing, and not part of the total; ``refresh_all`` lands them too.
"""

from __future__ import annotations

import json
import os
import pathlib
import tempfile
import time

from skyledger.checks import landing
from skyledger.checks.queries import QUERIES
from skyledger.plans import refresh
from skyledger.session import build_session, work_dir
from skyledger.sources import driver_tables

LARGE = ("lineitem.parquet", "orders.parquet", "customer.parquet", "part.parquet")
HEADLINE = [
    "fact_segment",
    "fact_market",
    "carrier_month",
    "airport_carrier_month",
    "route_carrier_month",
    "family_month",
    "airport_family_month",
    "route_load_factor",
    "share_gap",
    "hub_trend",
    "spokes",
    "destinations",
    "top_destinations_by_carrier",
    "route_performers",
    "yoy_momentum",
    "new_dropped_routes",
    "family_summary",
    "route_churn",
    "recent_moves",
    "load_replace_years",
    "refresh_all",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    shared = os.environ.get("BENCH_WORK_DIR") or tempfile.mkdtemp(prefix="run-")
    spark = build_session(
        f"local[{cpus}]",
        app="bench",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": shared,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str, tables: str) -> float:
        start = time.time()
        QUERIES[name](spark, tables).write.format("noop").mode("overwrite").save()
        return round(time.time() - start, 3)

    def laid_out(tables: str) -> str:
        base = work_dir(spark, "tables")
        for path in sorted(pathlib.Path(tables).glob("*.parquet")):
            df = spark.read.parquet(str(path))
            (df.repartition(2 * int(cpus)) if path.name in LARGE else df).write.parquet(f"{base}/{path.name}")
        return base

    smallest = pathlib.Path(sf_dir).parent / "sf0.001"
    if smallest.exists():
        for name in ("fact_segment", "airport_carrier_month"):
            run(name, str(smallest))
    tables = laid_out(sf_dir)
    seconds = {name: run(name, tables) for name in HEADLINE}
    root = landing.landed(spark, tables)
    start = time.time()
    refresh.refresh_all(spark, root, driver_tables.STAND_IN_FAMILIES)
    rebuilt = round(time.time() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(cpus),
                "refresh_landed_sec": rebuilt,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
