"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the local cores, ``BENCH_RUNS`` the timed
runs of each query, of which the median counts. Every run executes the whole query and
discards the rows. A first, untimed pass counts them.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import Observation
from pyspark.sql import functions as F

from checks.queries import queries
from tallyline import build_session

HEADLINE = [
    "revenue_by_month", "revenue_for_month", "lifetime_revenue", "outstanding_balance", "renewals_due",
    "plan_mrr", "invoice_history", "tenant_invoice_history", "outstanding_invoices", "usage_by_cycle",
    "meter_hourly", "prorate", "status_changes", "status_changes_from_feed", "audit_since",
    "rule_violations", "missing_months", "ledger_between", "to_event", "statement_top_total",
    "slowest_statements", "migrate_to_monthly", "upsert_usage", "meter_hourly_stream",
]
# They write to the lake; once is enough.
ONCE = {"migrate_to_monthly", "upsert_usage", "meter_hourly_stream"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = build_session(
        "tallyline-bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false", spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()

    def timed(name: str) -> float:
        begin = time.perf_counter()
        registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    def counted(name: str) -> float:
        begin, seen = time.perf_counter(), Observation()
        df = registered[name](spark, sf_dir).observe(seen, F.count(F.lit(1)).alias("rows"))
        df.write.format("noop").mode("overwrite").save()
        rows[name] = seen.get["rows"]
        return time.perf_counter() - begin

    # One pass over everything first, so that no query pays for starting the engine.
    rows: dict[str, int] = {}
    first = {name: counted(name) for name in HEADLINE if name not in ONCE}
    seconds = {}
    for name in HEADLINE:
        seconds[name] = round(statistics.median([timed(name) for _ in range(1 if name in ONCE else runs)]), 3)
        print(name, seconds[name], "first", round(first[name], 3) if name in first else "-", file=sys.stderr)
    print(json.dumps({
        "metric": "sum of warm medians", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "rows": rows, "runs": runs, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
