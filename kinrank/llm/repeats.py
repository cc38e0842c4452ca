"""From anchored contexts to removed windows: the shuffles that both substring operators share.

A *site* is one anchor of one document with the windows it answers for:
``core`` is the fingerprint of the anchor string, which lies inside every one
of those windows; ``ctx`` that of all the text they cover; ``lo``..``hi`` are
their starts. Two equal windows always lie at sites of equal core, so:

1. sites of equal (core, ctx) have equal windows throughout and are settled as
   a whole, without looking at a single window;
2. a core with one context only holds nothing that repeats otherwise;
3. for a core with several contexts, one site of each context is *open*: its
   windows are fingerprinted one by one (128 bits) and settled by value.

Copies thus cost one row per anchor, and single windows are only written out
where texts begin or cease to agree. Within an Arrow batch equal sites are
settled before the shuffle, so a context that a third of all documents hold
reaches the shuffle once per batch. Nothing is collected or broadcast.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinrank.llm.common import materialize, ranges

#: ``a`` holds 48 bits of the core, then the count of windows less one, then
#: whether the row is settled; in this order a shuffle's rows pack best.
SITES = "a long, ctx long, lo int, k long"
MOST = (1 << 15) - 1                  # windows in a row
FULL = (Window.unboundedPreceding, Window.unboundedFollowing)


def _runs(k, lo, hi):
    """Join touching windows of a document; in each, hi does not fall as lo grows."""
    order = np.lexsort((lo, k))
    k, lo, hi = k[order], lo[order], hi[order]
    if not len(k):
        return k, lo, hi
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (lo[1:] > hi[:-1] + 1)
    first = np.flatnonzero(new)
    return k[first], lo[first], np.maximum.reduceat(hi, first)


def settle_batch(core, ctx, k, lo, hi, keep_first: bool) -> pa.RecordBatch:
    """Rows for the shuffle from the sites of one Arrow batch: what repeats
    inside the batch is settled here, and one site of each context goes on."""
    order = np.lexsort((lo, k, ctx, core))
    core, ctx, k, lo, hi = (x[order] for x in (core, ctx, k, lo, hi))
    n = len(core)
    new = np.ones(n, bool)
    new[1:] = (core[1:] != core[:-1]) | (ctx[1:] != ctx[:-1])
    place = np.ones(n, bool)
    place[1:] = new[1:] | (k[1:] != k[:-1]) | (lo[1:] != lo[:-1])
    first = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    places = np.add.reduceat(place.astype(np.int64), first) if n else np.zeros(0, np.int64)
    if keep_first:                                   # all but the first place of a context
        done = (np.cumsum(place) - 1 - (np.cumsum(place) - 1)[first][group] > 0) if n else place
    else:                                            # every place of a context that has two
        done = places[group] > 1
    sk, slo, shi = _runs(k[done], lo[done], hi[done])
    pieces = -(-(shi - slo + 1) // MOST)
    slo = ranges(np.zeros(len(slo), np.int64), pieces) * MOST + np.repeat(slo, pieces)
    sk, shi = np.repeat(sk, pieces), np.minimum(slo + MOST - 1, np.repeat(shi, pieces))
    scatter = sk * np.int64(-7046029254386353131) + slo          # settled rows go anywhere
    a = np.concatenate([_pack(core[first], hi[first] - lo[first], 0), _pack(scatter, shi - slo, 1)])
    return pa.RecordBatch.from_arrays([
        pa.array(a), pa.array(np.concatenate([ctx[first], sk])),
        pa.array(np.concatenate([lo[first], slo]).astype(np.int32)), pa.array(np.concatenate([k[first], sk]))],
        names=["a", "ctx", "lo", "k"])


def _pack(core, more, settled):
    return (core & np.int64(~0xFFFF)) | (more << 1) | settled


def unpacked(sites: DataFrame) -> DataFrame:
    """``core, ctx, k, lo, hi, settled``, the rows of a core in one partition."""
    core = F.shiftrightunsigned("a", 16)
    return sites.repartition(core).select(
        core.alias("core"), "ctx", "k", "lo", (F.col("lo") + F.shiftright(F.col("a").bitwiseAND(0xFFFF), 1).cast("int")).alias("hi"),
        (F.col("a").bitwiseAND(1) == 1).alias("settled"))


def repeated_windows(docs: DataFrame, find_sites, window_hashes, keep_first: bool) -> DataFrame:
    """``_k, spans``: for each document with repeated windows the runs
    (lo, hi) of their starts, in no order and perhaps overlapping.

    ``docs`` has ``_k`` (not null), ``_b`` (text bytes) and what else the
    caller joins back. ``find_sites(bytes array) -> (row, core, ctx, lo, hi)``
    and ``window_hashes(bytes, starts) -> (first, second)`` see whole texts.
    With ``keep_first`` the first place of a repeated window (smallest _k,
    then start) is not reported, else every place is.
    """
    def sites(batches):
        for b in batches:
            row, core, ctx, lo, hi = find_sites(b.column("_b"))
            k = b.column("_k").to_numpy(zero_copy_only=False)[row] if len(row) else np.zeros(0, np.int64)
            yield settle_batch(core, ctx, k, lo, hi, keep_first)

    found = unpacked(docs.select("_k", "_b").mapInArrow(sites, SITES))
    by_core = Window.partitionBy("core").orderBy("ctx", "k", "lo")
    by_ctx = Window.partitionBy("core", "ctx").orderBy("k", "lo")
    is_first = F.coalesce(F.lag("ctx").over(by_core) != F.col("ctx"), F.lit(True))
    several = F.first("ctx").over(by_core.rowsBetween(*FULL)) != F.last("ctx").over(by_core.rowsBetween(*FULL))
    if keep_first:
        twice = F.dense_rank().over(by_ctx) > 1      # places, not rows: a row listed twice is one place
    else:
        full = by_ctx.rowsBetween(*FULL)
        twice = (F.first("k").over(full) != F.last("k").over(full)) | (F.first("lo").over(full) != F.last("lo").over(full))
    span = F.struct("lo", "hi")
    marked = (found.withColumn("_twice", twice).withColumn("_open", is_first & several)
              .select("k", "lo", "hi", (F.col("settled") | F.col("_twice")).alias("done"),
                      (~F.col("settled") & F.col("_open")).alias("open"))
              .where("done or open"))
    per_doc = materialize(marked.groupBy(F.col("k").alias("_k")).agg(
        F.collect_list(F.when(F.col("done"), span)).alias("done"),
        F.collect_list(F.when(F.col("open"), span)).alias("open")))

    def windows(batches):
        for b in batches:
            ks, texts, spans = b.column("_k").to_numpy(), b.column("_b"), b.column("open")
            first, second, k, lo = [], [], [], []
            for i in range(b.num_rows):
                flat = spans[i].values
                starts = _starts(flat.field(0).to_numpy(), flat.field(1).to_numpy())
                x, y = window_hashes(texts[i].as_buffer(), starts)
                first.append(x), second.append(y), k.append(np.full(len(starts), ks[i])), lo.append(starts)
            cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
            k, lo = cat(k), cat(lo)
            yield settle_batch(cat(first), cat(second), k, lo, lo, keep_first)

    one = unpacked(docs.join(per_doc.where(F.size("open") > 0).select("_k", "open").hint("shuffle_hash"), "_k")
                   .mapInArrow(windows, SITES))
    more = (one.withColumn("_again", twice).where("settled or _again")
            .groupBy(F.col("k").alias("_k")).agg(F.collect_list(span).alias("more")))
    none = F.array().cast("array<struct<lo:int,hi:int>>")
    return (per_doc.select("_k", "done").join(more, "_k", "full_outer")
            .select("_k", F.concat(F.coalesce("done", none), F.coalesce("more", none)).alias("spans"))
            .where(F.size("spans") > 0))


def _starts(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Distinct starts of the given runs, ascending."""
    if not len(lo):
        return np.zeros(0, np.int64)
    lo, hi = lo.astype(np.int64), hi.astype(np.int64)
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    lo[1:] = np.maximum(lo[1:], hi[:-1] + 1)
    return ranges(lo, np.maximum(hi - lo + 1, 0))


def covered(spans, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs [start, end) covered by windows of ``width`` starting in
    the runs of a list<struct<lo, hi>> value."""
    flat = spans.values
    lo, hi = flat.field(0).to_numpy().astype(np.int64), flat.field(1).to_numpy().astype(np.int64)
    order = np.argsort(lo, kind="stable")
    lo, end = lo[order], np.maximum.accumulate(hi[order]) + width
    new = np.ones(len(lo), bool)
    new[1:] = lo[1:] > end[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(lo)) - 1
    return lo[first], end[last]
