"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. Every query runs once to warm
up, then once on the clock, into a sink that computes all rows and keeps none.
"""

from __future__ import annotations

import json
import os
import time

from slackline.plans.queries import REGISTRY
from slackline.session import local_session

HEADLINE = [
    "panel_build",
    "lag_features",
    "engineered_frame",
    "temporal_holdout",
    "budget_eval",
    "eval_by_slice",
    "crosswalk_sums",
    "standard_preference",
    "numeric_clean_slack",
    "sheet_header_map",
    "union_by_name",
    "slack_by_region_year",
    "pct_diff_means",
    "describe_amounts",
    "describe_line_amounts",
    "duplicate_rows",
    "survey_funnel",
    "arm_distribution",
    "resubmission_rate",
    "age_groups",
    "welch_reduction",
    "chi_square_resubmission",
    "histogram_density_30",
    "lexicon_counts",
    "polarity_means",
    "word_frequency_top",
    "scaled_features",
    "gbt_forecast",
    "lag_entries",
    "duplicate_rows_expanded",
    "random_search",
    "ensemble_mean",
]


def run(spark, name: str, folder: str) -> float:
    began = time.perf_counter()
    REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench")
    seconds = {}
    for name in HEADLINE:
        run(spark, name, folder)
        seconds[name] = round(run(spark, name, folder), 3)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
