"""Times headline queries and prints one JSON line. Usage: python bench.py [name ...]."""

from __future__ import annotations

import json
import os
import sys
import time

from pulsegrid.session import local_session
from suite.queries import PLAIN

HEADLINE = ["window_rows_by_type", "carry_forward", "dn_quantile", "dn_moments", "en_shannonen", "dn_removepoints_absfar",
            "co_autocorr", "co_firstzero", "co_glscf", "en_apen", "en_sampen", "sb_binarystats", "sb_motiftwo", "sy_trend",
            "sc_dfa", "ex_movingthreshold", "dn_compareksfit_norm", "table_correlation", "feature_table_distribution",
            "feature_table", "feature_job_then_correlation", "provenance_closure"]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf}/events.parquet").groupBy("event_type").count().collect()  # start-up is not measured
    times = {}
    for name in names:
        start = time.time()
        PLAIN[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        if os.environ.get("BENCH_VERBOSE"):
            print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": sf.rstrip("/").rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
