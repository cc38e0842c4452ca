"""How the pair join spreads a hot item over tasks.

    python scripts/skew_check.py [sf_dir] [hot_threshold]

Takes the orders-form ratings and adds one item rated by every user (a key
whose pairs are n_users^2 / 2), then counts the joined pair rows produced in
each task of the join stage (``spark_partition_id`` of the join output)
for the plain self-join and for the hot-key split.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from kinrank.operators.pairs import pair_rows  # noqa: E402
from kinrank.session import build_session, materialize  # noqa: E402
from kinrank.sources.ratings import ratings_from_orders  # noqa: E402


def hot_ratings(spark, sf_dir):
    r = ratings_from_orders(spark, sf_dir)
    hot = r.groupBy("user_id").agg(F.max("rating").alias("rating")).select(
        "user_id", F.lit(-1).cast("bigint").alias("item_id"), "rating")
    return materialize(r.unionByName(hot))


def spread(rows):
    per = rows.groupBy(F.spark_partition_id().alias("task")).count()
    a = per.agg(F.sum("count").alias("total"), F.max("count").alias("largest"),
                F.count(F.lit(1)).alias("tasks")).first()
    return a["total"], a["largest"], a["tasks"]


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    h = int(sys.argv[2]) if len(sys.argv) > 2 else 256
    spark = build_session("local[8]", 16)
    r = hot_ratings(spark, sf)
    for name, thr in (("plain self-join", None), (f"split, hot_threshold={h}", h)):
        t0 = time.time()
        total, largest, tasks = spread(pair_rows(r, entity="user_id", through="item_id",
                                                 value="rating", hot_threshold=thr))
        print(f"{name:28s} pair rows {total:>10,d}  largest task {largest:>10,d} "
              f"({100.0 * largest / total:5.1f} %)  tasks {tasks:3d}  {time.time() - t0:5.1f} s")
    spark.stop()


if __name__ == "__main__":
    main()
