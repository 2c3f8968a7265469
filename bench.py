"""Headline queries at one scale; prints one JSON line.

BENCH_SF_DIR is the folder of parquet tables, BENCH_CPUS the number of local cores. Each query is
run in full (every row and column is produced) after one warm-up query over another folder. Layers are
those of a generation of this run's own, so the first query that needs one pays for building it. The number of exchanges and
file scans of each plan is reported beside the time.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from martkeeper.plans.registry import queries  # noqa: E402
from martkeeper.session import local_session  # noqa: E402
from martkeeper.sources.stored import GENERATION_KEY  # noqa: E402

HEADLINE = [
    "cycle_time_verify",
    "margin_by_channel",
    "payer_segment_margin",
    "fastest_channel_device",
    "margin_latest_quarter",
    "revenue_by_channel_device",
    "recurring_by_channel",
    "margin_by_region_device",
    "segment_speed_and_margin",
    "whatif_shift",
    "mv_fulfillment_rate",
    "mv_gross_margin",
    "mv_recurring_revenue",
    "mv_hcp_referral_performance",
    "silver_claims",
    "silver_revenue_summary",
    "gold_patients",
    "gold_claims",
    "gold_hcp",
    "dedup_lineitem",
    "month_growth",
    "running_order_value",
    "provider_referral_rollup",
    "fanout_check",
    "secure_patients_analyst",
    "token_join",
    "grant_actions",
    "audit_append",
    "grain_check",
    "seed_claims",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.conf.set(GENERATION_KEY, uuid.uuid4().hex)
    known = queries()
    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else HEADLINE
    warm = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    run(known["margin_by_channel"](spark, warm if os.path.isdir(warm) else folder))
    seconds: dict[str, float] = {}
    plans: dict[str, dict[str, int]] = {}
    for name in names:
        start = time.perf_counter()
        df = known[name](spark, folder)
        run(df)
        seconds[name] = round(time.perf_counter() - start, 3)
        plans[name] = plan_facts(df)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "total_time_headline_queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
                "plans": plans,
            }
        )
    )
    spark.stop()


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def plan_facts(df) -> dict[str, int]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return {"exchanges": plan.count("Exchange "), "scans": plan.count("FileScan ")}


if __name__ == "__main__":
    main()
