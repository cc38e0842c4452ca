"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

``BENCH_EVENT_LOG_DIR`` (optional) writes Spark's event log there;
``scripts/stage_times.py`` summarises it per stage.

Prints one JSON line: total seconds over the headline queries plus each
query's seconds. Every query is run to completion with the ``noop`` sink
(full computation, nothing collected). The headline set first runs once on
the sf0.001 tables so JVM start-up and code generation are not charged to
the first query timed.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kinrank.operators import neighbours, predict  # noqa: E402
from kinrank.operators.threshold import similar_above  # noqa: E402
from kinrank.plans import catalog  # noqa: E402
from kinrank.session import build_session, materialize  # noqa: E402


def chain_events(spark, d):
    """The flagship chain on the events form: overlap similarity -> top 10
    over 0.5 -> predictions -> top 5 unrated items."""
    train, test = catalog.events_split(spark, d)
    sims = similar_above(train, catalog.THRESHOLD, "overlap")
    nb = materialize(neighbours.top_neighbours(sims, catalog.N_NEIGHBOURS, catalog.THRESHOLD,
                                               test.select("user_id")))
    preds = predict.exclude_rated(predict.predict_from_neighbours(nb, train), train)
    return predict.top_n(preds, catalog.TOP)


def nbcf_orders(spark, d):
    """k-nearest-rater scoring of every orders-form test cell (R4 + E6)."""
    train, test = catalog.orders_split(spark, d)
    return catalog._nbcf_rows(train, test)


HEADLINE = {
    "chain_orders": catalog.q_recommend_top_n,
    "chain_events": chain_events,
    "similarity_corated": catalog.q_similarity_corated,
    "similarity_cosine": catalog.q_similarity_cosine,
    "rmse_by_n": catalog.q_rmse_by_n,
    "predict_nbcf": catalog.q_predict_nbcf,
    "nbcf_orders": nbcf_orders,
    "als_evaluate": catalog.q_als_evaluate,
    "recommend_nbcf": catalog.q_recommend_nbcf,
    "rmse_by_n_corated": catalog.q_rmse_by_n_corated,
    "als_recommend": catalog.q_als_recommend,
    "recommend_final": catalog.q_recommend_final,
}


def run(spark, fn, d):
    t0 = time.time()
    fn(spark, d).write.format("noop").mode("overwrite").save()
    return time.time() - t0


def main():
    d = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    log_dir = os.environ.get("BENCH_EVENT_LOG_DIR")          # optional: stage/task times
    extra = ({"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
              "spark.eventLog.compress": "false"} if log_dir else None)
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2), extra=extra)
    warm = os.path.join(os.path.dirname(d.rstrip("/")), "sf0.001")
    for fn in HEADLINE.values():                             # JIT warm-up on the smallest tables
        run(spark, fn, warm if os.path.isdir(warm) else d)
    times, failed = {}, []
    for k, fn in HEADLINE.items():
        try:
            times[k] = round(run(spark, fn, d), 3)
        except Exception as e:  # noqa: BLE001 - report the failure, keep timing the rest
            times[k] = None
            failed.append(f"{k}: {type(e).__name__}: {str(e)[:200]}")
    m = re.search(r"sf([0-9.]+)", d)
    out = {"metric": "headline_total", "value": round(sum(v for v in times.values() if v), 3),
           "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else d}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
