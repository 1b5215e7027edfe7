"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run twice into a no-op sink over all its columns; the second, warm time counts. Only the
plan is warm: nothing is cached between the runs, every run reads the tables again.
"""

from __future__ import annotations

import json
import os
import time

from matchlab.session import local_session
from suite.queries import QUERIES

HEADLINE = [
    "rest_days",
    "ladder_join_lag",
    "pair_matches",
    "ewma_team_lagged",
    "ewma_team_hot_keys",
    "ewma_player_rates",
    "ewma_player_skip",
    "player_rates",
    "group_scale",
    "team_rollup",
    "elo_ratings",
    "elo_time_blocks",
    "elo_grid_logloss",
    "fuzzy_left_join",
    "fixture_ids",
    "rolling_origin_folds",
    "odds_devig_logloss",
    "upsert_idempotent",
    "model_frame",
    "gbt_stump_scores",
    "gbt_predictions",
    "ewma_stats_skip",
    "versioned_merge",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench")
    seconds = {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_wall_clock",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
