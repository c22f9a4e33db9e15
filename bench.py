"""Time the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]`` and print one JSON line.

Each query runs once cold and once warm; the warm time counts. Results go to the
no-op sink, so the whole plan runs and nothing is brought to the driver.
"""

from __future__ import annotations

import json
import os
import time

from ledgerloom.catalog import all_queries
from ledgerloom.session import local_session

HEADLINE = [
    "cohort_retention", "daily_fee_running_total", "top_agents_per_division", "above_average_agents", "transaction_point_lookup",
    "transactions_with_agent_rank_and_share", "monthly_category_pivot", "fee_per_agent_and_service", "agents_left_transactions",
    "transactions_cleaned", "transactions_reject_counts", "containers_cleaned", "broker_history", "importer_history", "congestion_features",
    "value_density_percentile", "clearance_features", "date_folds", "arrears_events", "repayment_history_known", "arrears_features",
    "contact_recommendation", "full_action_plan", "weekly_book", "portfolio_ranking_cash", "policy_comparison", "ranking_metrics_by_split",
    "promise_states", "payment_reconciliation", "officer_leaderboard", "portfolio_at_risk", "provisions_by_bucket",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, memory=os.environ.get("BENCH_MEMORY", "12g"))
    spark.sparkContext.setLogLevel("ERROR")
    queries, times = all_queries(), {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": cpus}))


if __name__ == "__main__":
    main()
