"""Time the headline queries. Prints one JSON line.

Data folder: $BENCH_SF_DIR (default /root/testdata/sf0.1), threads: $BENCH_CPUS (default 8).
Each query runs once to warm up and then once timed; results go to the noop sink. ``plan`` is the part of the time that
building and optimizing the plan takes, which does not grow with the data.
"""

from __future__ import annotations

import json
import os
import sys
import time

from logloom.catalog import QUERIES
from logloom.session import local_session

HEADLINE = (
    "ingest_apache_access ingest_nginx_access ingest_apache_error ingest_nginx_error ingest_mysql_error ingest_all "
    "decode_beat_basic decode_flat_json grok_access grok_nginx_error grok_multi parse_date parse_date_multi geo_enrich "
    "ua_enrich kv_map split_spans_words json_path json_flatten xml_path xml_flatten anomaly_web label_weighted mut_arith_int route_by_type "
    "rotate_hour apply_mapping config_latest_by_type config_latest_by_user_type config_entries token_alias quota_check "
    "usage_company stream_end_to_end geo_enrich_nested json_paths_deep mapping_dynamic quota_check_rounds stream_counters"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), "logloom-bench")
    spark.sparkContext.setLogLevel("ERROR")
    seconds, plan = {}, {}
    for name in names:
        for _ in range(2):
            started = time.perf_counter()
            df = QUERIES[name](spark, sf_dir)
            df._jdf.queryExecution().executedPlan()
            plan[name] = round(time.perf_counter() - started, 3)
            df.write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "plan": plan,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
