"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query is run to its last row with the no-op sink. Tables that several queries share are
written once per application, as the first query that needs them; `base_tables` times that on
its own, so the others show their own work.
"""
from __future__ import annotations

import json
import os
import time

from lettera.plans import registry
from lettera.session import local_session

HEADLINE = [
    "modelable_population", "weighted_vs_simple_rate", "network_context", "school_census_agg", "early_childhood",
    "network_table", "abt", "weighted_groups", "check_group_invariance", "check_join_fanout", "group_folds",
    "column_profile", "shape_diagnostics", "missing_patterns", "rate_by_quantile", "gradient_pattern",
    "response_correlation", "spearman_matrix", "curate_redundancy", "impute_by_group", "metrics_weighted",
    "calibration_bins", "baselines", "slice_report", "risk_list", "region_profile", "region_overlap",
    "probability_bands", "focus_contrast", "fit_logistic", "fit_forest", "cross_validate", "test_evaluation",
    "partial_dependence", "permutation_importance",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench")
    spark.range(1000).selectExpr("sum(id)").collect()      # start the engine
    queries, times = registry.queries(), {}

    def timed(name, work):
        start = time.time()
        work()
        times[name] = round(time.time() - start, 3)

    ws = registry.workspace(spark, sf_dir)
    timed("base_tables", lambda: ws.units.count())
    for name in HEADLINE:
        timed(name, lambda: queries[name](spark, sf_dir).write.mode("overwrite").format("noop").save())
    spark.stop()
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
