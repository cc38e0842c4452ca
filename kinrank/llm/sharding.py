"""Operator 6, sharding by a minimax contiguous partition. The law is ``bytes``.

Documents of equal text form an atomic group, groups stand in the order of
their texts' hash, and the shards are stretches of that order. The smallest
capacity that ``shards`` stretches can keep is found by binary search, checked
greedily: each stretch takes all that fits. The cuts are then made under that
capacity, each stretch as near its even share of the rest as it can be.

The greedy check needs only "the last group that ends at or before x". The
driver holds a summary of the groups' ends (at most POINTS stretches: first
end, last end, count) and refines it only around places where a cut can fall,
one aggregate over the written prefix sums each time. Where the summary leaves
an end open, a search with the least and one with the greatest possible end
bound the answer from both sides. Everything else is DataFrame operations.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinrank.llm.common import materialize

SHARDS = 8
POINTS = 4096
SALT_ROWS = 100_000


class Ends:
    """Ends of the groups on the byte scale, known as finely as asked for."""

    def __init__(self, groups: DataFrame):
        self.groups = groups                                        # bucket, end
        rows = groups.groupBy("bucket").agg(F.min("end").alias("a"), F.max("end").alias("b"), F.count(F.lit(1)).alias("n")).collect()
        self.set(sorted((r["a"], r["b"], r["n"]) for r in rows))
        self.total = self.b[-1] if self.b else 0

    def set(self, stretches):
        self.a, self.b, self.n = ([s[i] for s in stretches] for i in range(3))

    def at(self, x: int, most: bool) -> int:
        """The last end at or before x: the least it can be, or the ``most``."""
        i = bisect_right(self.a, x) - 1
        if i < 0:
            return 0
        if x >= self.b[i]:
            return self.b[i]
        return x if most and self.n[i] > 2 else self.a[i]

    def refine(self, spans: list[tuple[int, int]]) -> bool:
        """Look closer at all open stretches that meet the spans [x, y]."""
        pick = [i for i in range(len(self.a)) if self.n[i] > 2 and any(self.a[i] <= y and x < self.b[i] for x, y in spans)]
        if not pick:
            return False
        width = max(1, -(-sum(self.b[i] - self.a[i] + 1 for i in pick) // POINTS))
        merged: list[list[int]] = []
        for i in pick:
            if merged and i == merged[-1][2] + 1:
                merged[-1][1:] = [self.b[i], i]
            else:
                merged.append([self.a[i], self.b[i], i])
        lo, hi = F.array(*[F.lit(m[0]) for m in merged]), F.array(*[F.lit(m[1]) for m in merged])
        inside = F.exists(F.arrays_zip(lo.alias("x"), hi.alias("y")), lambda s: (F.col("end") >= s["x"]) & (F.col("end") <= s["y"]))
        found = (self.groups.where(F.col("end").between(merged[0][0], merged[-1][1]) & inside)
                 .groupBy(F.floor(F.col("end") / width)).agg(F.min("end").alias("a"), F.max("end").alias("b"), F.count(F.lit(1)).alias("n"))
                 .collect())
        taken = set(pick)
        keep = [(self.a[i], self.b[i], self.n[i]) for i in range(len(self.a)) if i not in taken]
        self.set(sorted(keep + [(r["a"], r["b"], r["n"]) for r in found]))
        return True

    def exact(self, x: int) -> int:
        while self.at(x, True) != self.at(x, False):
            self.refine([(x, x)])
        return self.at(x, True)


def _greedy(ends: Ends, capacity: int, shards: int, most: bool, start: int = 0) -> list[int] | None:
    """The ends of greedy stretches, or None if more than ``shards`` are needed."""
    cuts = []
    while start < ends.total:
        if len(cuts) == shards:
            return None
        to = ends.at(start + capacity, most)
        if to <= start:
            return None
        cuts.append(to)
        start = to
    return cuts


def _least(ends: Ends, shards: int, most: bool) -> int:
    lo, hi = 0, ends.total
    while lo < hi:
        mid = (lo + hi) // 2
        if _greedy(ends, mid, shards, most) is None:
            lo = mid + 1
        else:
            hi = mid
    return lo


def cut_points(ends: Ends, shards: int = SHARDS) -> tuple[int, list[int]]:
    """The least capacity, and the ends of all shards but the last."""
    while True:
        low, high = _least(ends, shards, True), _least(ends, shards, False)
        if low == high:
            break
        spans, least, most = [], 0, 0                 # where a stretch under low..high can end
        for _ in range(shards):
            spans.append((least + low, most + high))
            least, most = max(least, ends.at(least + low, False)), ends.at(most + high, True)
        if not ends.refine(spans) and not ends.refine([(0, ends.total)]):
            break
    capacity, start, cuts = high, 0, []
    for left in range(shards, 1, -1):
        even = -(-(ends.total - start) // left)
        near = ends.exact(min(start + even, start + capacity))
        if near <= start or not _fits(ends, near, capacity, left - 1):
            near = ends.exact(start + capacity)
        cuts.append(near)
        start = near
    return capacity, cuts


def _fits(ends: Ends, start: int, capacity: int, shards: int) -> bool:
    for _ in range(shards):
        if start >= ends.total:
            return True
        start = ends.exact(start + capacity)
    return start >= ends.total


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot``, one row per row of ``docs``.

    Size is the text's UTF-8 bytes and one; null texts count as empty and
    belong to the group of empty texts. Slots number the rows of a shard from
    0 by (salt, doc_id). Null and repeated ids, ties and repeated rows are
    rows like any other; an empty table gives none; other columns are ignored.
    """
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    d = materialize(docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
                                F.unhex(F.sha2(text, 256)).alias("_h")))
    groups = d.groupBy("_h").agg(F.sum("size").alias("bytes"))
    groups = groups.withColumn("bucket", F.conv(F.substring(F.hex("_h"), 1, 3), 16, 10).cast("int"))      # 4096 at most
    inside = Window.partitionBy("bucket").orderBy("_h").rowsBetween(Window.unboundedPreceding, 0)
    tally = groups.groupBy("bucket").agg(F.sum("bytes").alias("b"))
    base = tally.select("bucket", F.coalesce(F.sum("b").over(Window.orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    groups = materialize(groups.withColumn("_in", F.sum("bytes").over(inside)).join(F.broadcast(base), "bucket")
                         .select("_h", "bucket", (F.col("base") + F.col("_in")).alias("end")))
    _, cuts = cut_points(Ends(groups), shards)
    number = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < F.col("end"))) if cuts else F.lit(0)
    placed = d.join(groups.select("_h", number.alias("shard")), "_h").drop("_h")
    salts = max(1, -(-d.count() // SALT_ROWS))
    placed = placed.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(salts)))
    parts = placed.groupBy("shard", "_salt").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("shard", "_salt", F.coalesce(before, F.lit(0)).alias("_base"))
    rank = F.row_number().over(Window.partitionBy("shard", "_salt").orderBy("doc_id", "text_crc32"))
    return (placed.withColumn("_rank", rank - 1).join(parts, ["shard", "_salt"])
            .select("doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"),
                    (F.col("_base") + F.col("_rank")).cast("long").alias("slot")))


def op6(spark, sf_dir):
    from kinrank.llm.common import table

    out = shard(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
