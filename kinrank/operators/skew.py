"""Equi-join with hot-key splitting.

A join key whose rows number more than ``hot_threshold`` on either side
(for instance an item rated by a third of all users, or a neighbour of
very many users) is split into chunks by a hash of a per-row column:
``ceil(m_left / H)`` chunks on the left and ``ceil(m_right / H)`` on the
right. Every left chunk meets every right chunk in its own join cell
(left rows are copied once per right chunk and the other way round), so each
cell holds at most ``H`` x ``H`` row pairs of one key and the work of a hot key
spreads over many tasks. Ordinary keys keep a single cell, with no copies.

Whether any key is hot is decided by one small aggregate (an action) before
the plan is built: with no hot key, the plain join runs. The same aggregate
gives the exact joined-row count, sum over keys of m_left * m_right, which
sets the join's task count (``output_partitions``) so that each task makes a
bounded number of rows however much the join multiplies its inputs. The hot-key table
is broadcast only when its row count is at most ``broadcast_limit``;
beyond that it is shuffle-joined on (key, part), each row being given one of
``SUB_BUCKETS`` parts and the table copied once per part, so no key is whole
in one task on the way there either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinrank.session import parallelism

DEFAULT_HOT_THRESHOLD = 4096
DEFAULT_BROADCAST_LIMIT = 2_000_000
ROWS_PER_TASK = 20_000_000          # joined rows a join task is sized for
SUB_BUCKETS = 64                    # parts of a hot key where the hot table is joined by a shuffle


def _key_counts(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    cl = left.groupBy(key).agg(F.count(F.lit(1)).alias("_ml"))
    cr = right.groupBy(key).agg(F.count(F.lit(1)).alias("_mr"))
    return cl.join(cr, key)                        # only keys on both sides meet


def _hot(counts: DataFrame, key: str, hot_threshold: int) -> DataFrame:
    h = F.lit(hot_threshold)
    return (counts.where((F.col("_ml") > h) | (F.col("_mr") > h))
            .select(key,
                    F.greatest(F.lit(1), F.ceil(F.col("_ml") / h)).cast("int").alias("_sl"),
                    F.greatest(F.lit(1), F.ceil(F.col("_mr") / h)).cast("int").alias("_sr")))


def hot_keys(left: DataFrame, right: DataFrame, key: str, hot_threshold: int) -> DataFrame:
    """``key, _sl, _sr``: keys with more than ``hot_threshold`` rows on a side,
    with the number of chunks per side."""
    return _hot(_key_counts(left, right, key), key, hot_threshold)


def join_profile(left: DataFrame, right: DataFrame, key: str,
                 hot_threshold: int) -> tuple[DataFrame, int, int]:
    """``(hot-key table, number of hot keys, joined rows)`` from one small
    aggregate job: the joined-row count is ``sum(m_left * m_right)`` over keys,
    known before any pair is made."""
    counts = _key_counts(left, right, key)
    h = F.lit(hot_threshold)
    row = counts.agg(
        F.sum(F.when((F.col("_ml") > h) | (F.col("_mr") > h), 1).otherwise(0)).alias("n_hot"),
        F.sum(F.col("_ml").cast("double") * F.col("_mr")).alias("rows")).first()
    return _hot(counts, key, hot_threshold), int(row["n_hot"] or 0), int(row["rows"] or 0)


def output_partitions(spark, joined_rows: int) -> int:
    """Tasks for a row-multiplying join: enough that each makes about
    ``ROWS_PER_TASK`` joined rows, never fewer than the session's shuffle
    partitions."""
    need = -(-joined_rows // ROWS_PER_TASK)
    return int(max(parallelism(spark), need))


def split_join(left: DataFrame, right: DataFrame, key: str, left_salt: str, right_salt: str,
               cond: Column | None = None, hot_threshold: int | None = DEFAULT_HOT_THRESHOLD,
               broadcast_limit: int = DEFAULT_BROADCAST_LIMIT) -> DataFrame:
    """Inner equi-join of ``left`` and ``right`` on ``key`` (plus ``cond``),
    with hot keys split as described above and the task count sized by the
    measured joined-row count. The two sides must not share column names
    other than ``key``; ``left_salt`` / ``right_salt`` name the columns whose
    hash assigns a row to its chunk."""
    spark = left.sparkSession
    if hot_threshold is None:
        return _plain(left, right, key, cond, parallelism(spark))
    hot, n_hot, rows = join_profile(left.select(key), right.select(key), key, hot_threshold)
    n = output_partitions(spark, rows)
    if n_hot == 0:
        return _plain(left, right, key, cond, n)
    return salted_join(left, right, key, left_salt, right_salt, hot, n_hot, cond, broadcast_limit, n)


def _plain(left, right, key, cond, n):
    # Both sides hash-partitioned on the key with an explicit count: the join
    # multiplies rows, so its task count must not follow the small inputs.
    j = left.repartition(n, key).join(right.repartition(n, key), key)
    return j.where(cond) if cond is not None else j


def salted_join(left: DataFrame, right: DataFrame, key: str, left_salt: str, right_salt: str,
                hot: DataFrame, n_hot: int, cond: Column | None = None,
                broadcast_limit: int = DEFAULT_BROADCAST_LIMIT, n: int | None = None) -> DataFrame:
    """The split form of the join, given the hot-key table and its row count."""
    one = F.lit(1)

    def with_hot(rows, salt):
        if n_hot <= broadcast_limit:
            return rows.join(F.broadcast(hot), key, "left")
        part = F.pmod(F.xxhash64(salt, F.lit(1)), F.lit(SUB_BUCKETS)).cast("int")
        copies = hot.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SUB_BUCKETS - 1))))
        return rows.withColumn("_part", part).join(copies, [key, "_part"], "left").drop("_part")

    ls = (with_hot(left, left_salt)
          .withColumn("_p", F.pmod(F.xxhash64(left_salt), F.coalesce("_sl", one)).cast("int"))
          .withColumn("_q", F.explode(F.sequence(F.lit(0), F.coalesce("_sr", one) - 1)))
          .drop("_sl", "_sr"))
    rs = (with_hot(right, right_salt)
          .withColumn("_q", F.pmod(F.xxhash64(right_salt), F.coalesce("_sr", one)).cast("int"))
          .withColumn("_p", F.explode(F.sequence(F.lit(0), F.coalesce("_sl", one) - 1)))
          .drop("_sl", "_sr"))
    n = n or parallelism(left.sparkSession)
    j = (ls.repartition(n, key, "_p", "_q")
         .join(rs.repartition(n, key, "_p", "_q"), [key, "_p", "_q"]).drop("_p", "_q"))
    return j.where(cond) if cond is not None else j
