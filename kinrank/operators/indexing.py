"""Distributed dense index and chunked range generation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinrank.session import materialize


def dense_index(df: DataFrame, col: str, name: str = "idx") -> DataFrame:
    """``col, idx``: 1-based position of each distinct value of ``col`` in
    ascending order, without moving all values into one task.

    The distinct values are range-partitioned and sorted, then kept
    (``session.materialize``), so both passes below see the same partitions. Each row's position inside
    its partition comes from ``monotonically_increasing_id``; partition
    offsets come from a per-partition count, a table with one row per
    partition, so it is safe to rank and broadcast.
    """
    d = df.select(col).distinct().orderBy(col)
    d = materialize(d.withColumn("_pid", F.spark_partition_id())
                    .withColumn("_mid", F.monotonically_increasing_id()))
    counts = d.groupBy("_pid").agg(F.count(F.lit(1)).alias("_c"), F.min("_mid").alias("_m0"))
    offs = counts.withColumn(
        "_off", F.coalesce(F.sum("_c").over(Window.orderBy("_pid").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)))
    return (d.join(F.broadcast(offs.select("_pid", "_off", "_m0")), "_pid")
            .select(col, (F.col("_off") + F.col("_mid") - F.col("_m0") + F.lit(1)).alias(name)))


def explode_range(df: DataFrame, upper: str, name: str = "idx", chunk: int = 4096) -> DataFrame:
    """One row per value 1..``upper`` for each input row, generated in two
    steps (chunk starts, reshuffled, then values) so a row with a very large
    ``upper`` is spread over many tasks instead of expanding in one."""
    starts = df.withColumn("_start", F.explode(F.sequence(
        F.lit(1), F.greatest(F.col(upper), F.lit(1)), F.lit(chunk))))
    starts = starts.where(F.col(upper) >= 1).repartition("_start", *[c for c in df.columns if c != upper][:1])
    out = starts.withColumn(name, F.explode(F.sequence(
        F.col("_start"), F.least(F.col(upper), F.col("_start") + F.lit(chunk - 1)))))
    return out.drop("_start")
