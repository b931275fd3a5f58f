"""Time the headline queries; prints one JSON line. Every query's result is computed in full (noop sink)."""

import json
import os
import sys
import time
from statistics import median

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])

HEADLINE = (
    "kpi01_top5", "kpi02_branch_trend", "kpi03_product_revenue", "kpi04_dormant", "kpi05_suspicious", "kpi06_rfm", "kpi07_branch_rank", "kpi08_kyc_exposure", "kpi09_refund_rate", "kpi10_scorecard",
    "kpi11_reconciliation", "kpi12_transitions", "kpi13_activation", "rule_reject_first_error", "dedup_near", "scd2_merge", "pit_resolve", "fact_upsert", "status_close_match", "scorecard_top_reasons",
)


def main() -> None:
    from tidemark.queries import QUERIES
    from tidemark.session import session

    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = session(f"local[{cpus}]", int(cpus), **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g")})
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").write.format("noop").mode("overwrite").save()  # the session's own start
    took = {}
    for name in HEADLINE:
        runs = []
        for _ in range(2):  # the first run compiles the plan's code
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        took[name] = round(min(runs), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "median": round(median(took.values()), 3), "sf": sf_dir.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
