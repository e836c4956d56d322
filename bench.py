"""Time the headline queries: median of three runs each, one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from wicketworks.catalog import QUERIES
from wicketworks.session import create_session

HEADLINE = [
    "c01_clean_deliveries",
    "c04_batting",
    "c07_teams",
    "c08_player_stats",
    "c09_ball_by_ball",
    "c10_match_teams",
    "c11_match_players",
    "c12_common_balls",
    "c13_match_samples",
    "w02_exclusive_sum",
    "w06_running_total_with_ties",
    "w08_forward_fill",
    "j02_inner_three_keys",
    "x04_restrict_lines",
    "a08_ball_sequences",
    "m05_padded_batches",
    "e04_staged_scores",
    "e08_area_under_curve",
    "e15_column_profile",
]
RUNS = 3


def run(spark, name: str, directory: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, directory).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    settings = {
        "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
    }
    spark = create_session("bench", settings, f"local[{cpus}]")
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, "a01_shape", directory)
    times = {n: statistics.median(run(spark, n, directory) for _ in range(RUNS)) for n in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "total of median seconds over headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": {n: round(s, 3) for n, s in times.items()},
                "sf": directory.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
