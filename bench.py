"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the
cores. Each query is run once to warm the session up on the flagship, then timed
to the end of its result.
"""

from __future__ import annotations

import json
import os
import time

from furlong.queries import QUERIES
from furlong.session import build_session

HEADLINES = (
    "entity_metrics_long", "midrank_grade", "latest_row_per_key", "mode_spelling", "coverage_pair", "upsert_coalesce", "replace_partition", "fill_blanks", "fill_blanks_audit",
    "unique_match", "theta_unique", "staged_match", "connected_components", "subtree_index", "lap_cumulative", "collect_combo", "json_props", "html_links", "ws_normalize",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    done = {}
    for name in (HEADLINES[0], *HEADLINES):
        begun = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        done[name] = round(time.perf_counter() - begun, 3)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(done.values()), 3), "unit": "sec", "queries": done, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
