"""Helpers shared by the training-data operators: table access, row keys, Arrow batches."""

from __future__ import annotations

import os

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinrank.operators.indexing import dense_index
from kinrank.session import materialize

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
BATCH_BYTES = 32 << 20                # bytes that an Arrow batch holds before it ends
ROW_BATCH_BYTES = 4 << 20             # the same for operators that judge each row alone
GROUP_BYTES = 1 << 21                 # bytes of text that a task's vector code works on at a time


def ship(spark: SparkSession) -> None:
    """Let Python workers that share this file system import the package. A
    cluster whose executors do not see the repository ships it (``--py-files``)."""
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "")
    if ROOT not in have.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (have, ROOT) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_sized(df: DataFrame, rows: int = 2000, size: int = BATCH_BYTES) -> DataFrame:
    """Set the rows per Arrow batch for frames that carry whole texts; a batch
    also ends at ``size`` bytes, so long texts do not pile up."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))
    return df


def text_bytes(col: str = "text") -> Column:
    """The text as UTF-8 bytes, null as none."""
    return F.coalesce(F.col(col).cast("binary"), F.lit(b""))


def keys_are_unique(docs: DataFrame) -> bool:
    """Whether every row has a doc_id of its own."""
    seen = (docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
            .agg(F.max("n").alias("most"), F.sum(F.col("doc_id").isNull().cast("int")).alias("nulls")).first())
    return (seen["most"] or 0) <= 1 and not seen["nulls"]


def keyed(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``_k``, a whole number that orders documents by doc_id.

    ``_k`` is doc_id where no id repeats and none is null (one aggregate over
    the ids finds out). Otherwise rows are ordered by (doc_id, nulls last,
    hash of the text): rows that repeat both id and text are one document
    listed more than once and share a key, so they get equal answers.
    """
    if keys_are_unique(docs):
        return docs.withColumn("_k", F.col("doc_id").cast("long"))
    with_hash = docs.withColumn("_t", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    order = F.struct(F.col("doc_id").isNull().alias("a"), F.coalesce("doc_id", F.lit(0)).cast("long").alias("b"),
                     F.col("_t").alias("c"))
    index = dense_index(with_hash.select(order.alias("_o")), "_o", "_k")
    return (with_hash.withColumn("_o", order).join(index, "_o")
            .withColumn("_k", F.col("_k").cast("long")).drop("_o", "_t"))


def lowest(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """One row for each of the ``rows`` smallest values of ``key``, a 64-bit hash.

    Only the values under a bound are looked at, the one under which about four
    times as many as asked for lie if none repeats. Where rows repeat and too
    few values are found, the bound is raised, so the result is the same at any
    size, and the driver gets ``rows`` numbers a step."""
    share = 4 * rows / max(1, df.count())
    while True:
        under = df if share >= 1 else df.where(key < F.lit(int(-(1 << 63) + share * (1 << 64))))
        found = under.select(key.alias("_h")).distinct().orderBy("_h").limit(rows).collect()
        if share >= 1 or len(found) == rows:
            break
        share *= 16
    if not found:
        return df.limit(0)
    return under.where(key <= F.lit(found[-1][0])).withColumn("_h", key).dropDuplicates(["_h"]).drop("_h")


def values(array) -> tuple[np.ndarray, np.ndarray]:
    """A binary or string Arrow array without nulls: its bytes and its offsets."""
    import pyarrow as pa

    wide = pa.types.is_large_binary(array.type) or pa.types.is_large_string(array.type)
    _, off, data = array.buffers()
    kind = np.int64 if wide else np.int32
    off = np.frombuffer(off, kind)[array.offset:array.offset + len(array) + 1].astype(np.int64) if off else np.zeros(1, np.int64)
    if data is None:
        return np.zeros(0, np.uint8), off - off[0]
    return np.frombuffer(data, np.uint8)[off[0]:off[-1]], off - off[0]


def groups(off: np.ndarray, size: int = GROUP_BYTES):
    """Runs of rows (first, end) of about ``size`` bytes, one row at least."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + size, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0]+1, ... (count[0] of them), first[1], ..."""
    total = int(count.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(count)
    return np.arange(total, dtype=np.int64) + np.repeat(first - (ends - count), count)


def signed(x) -> np.ndarray:
    return np.asarray(x, dtype=np.uint64).view(np.int64)


__all__ = ["GROUP_BYTES", "ROW_BATCH_BYTES", "arrow_sized", "groups", "keyed", "keys_are_unique", "lowest", "materialize", "ranges", "ship", "signed",
           "table", "text_bytes", "values"]
