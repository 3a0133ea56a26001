"""Time the headline query keys.

Runs each key on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default
``/root/testdata/sf0.1``) and prints one JSON line.

* ``queries`` (and ``value``, their sum): each key cold -- a fresh query
  context and an empty cache, so the derived tables, the staging models, the
  checkpointed long table and every size check are part of its time.
* ``queries_warm``: the same keys run one after another in one shared context,
  the way a long-running service answers requests once the daily tables
  exist; each number is the key's own incremental time.

Every key runs in full through the ``noop`` sink (no driver collect).  Before
timing, the flagship runs once on a smaller copy of the data so JIT
compilation is not billed to the first key.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "stg_employees", "stg_competencies_yearly", "unpivot_traits", "benchmark_profile", "match_scores",
    "talent_match", "talent_match_candidates", "ranked_candidates", "group_averages",
    "compare_to_benchmark", "baseline_profile", "global_rank",
]


def _run(spark, catalog, key, sf_dir):
    t0 = time.perf_counter()
    catalog.QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - t0, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    keys = os.environ.get("BENCH_QUERIES")
    from traitmatch.plans import catalog
    from traitmatch.session import get_session

    selected = list(catalog.QUERIES) if keys == "all" else (keys.split(",") if keys else HEADLINE)
    spark = get_session(f"local[{cpus}]", int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)),
                        driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
    # JIT warm-up on a smaller copy of the data (falls back to the timed data)
    parent = os.path.dirname(sf_dir.rstrip("/"))
    warm_dirs = [d for d in (os.path.join(parent, "sf0.01"), os.path.join(parent, "sf0.001"))
                 if os.path.isdir(d) and os.path.abspath(d) != os.path.abspath(sf_dir)]
    _run(spark, catalog, "talent_match", warm_dirs[0] if warm_dirs else sf_dir)

    cold: dict[str, float] = {}
    for key in selected:
        catalog.release(spark)
        cold[key] = _run(spark, catalog, key, sf_dir)

    catalog.release(spark)
    warm = {key: _run(spark, catalog, key, sf_dir) for key in selected}

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(cold.values()), 3),
        "unit": "sec",
        "queries": cold,
        "queries_warm": warm,
        "warm_total": round(sum(warm.values()), 3),
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
