"""Operator 1, repeated strings by anchored window fingerprints.

In place of suffix arrays by prefix-free parsing: there is no dictionary of
distinct phrases, no suffix array of dictionary or parse, and no corpus order.
Only the parse's triggers are kept, as anchors.

Anchors: a rolling hash runs over the bytes of each document; where it is no
larger than at any place within RADIUS bytes to either side, the string of
``2 * RADIUS + TAIL`` bytes around that place is a trigger. Which triggers a
text has depends on its own bytes alone, so equal windows hold equal triggers.

Grouping (repeats.py, as for operator 10): equal fingerprints of a trigger and
its context, to the window's length, are equal occurrences; only triggers met
in several contexts have their windows looked at one by one. Removal needs
equal neighbours and not the alphabet, so fingerprints do (64 bits for a
trigger, 128 for a window). Stretches without a trigger for a whole window are
taken window by window.

Memory of a task is bounded by an Arrow batch; the whole text is shuffled once
(both later uses share that exchange).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinrank.llm.common import arrow_sized, groups, keyed, ranges, ship, signed, text_bytes, values
from kinrank.llm.repeats import covered, repeated_windows

WIDTH = 100
RADIUS, TAIL = 16, 4
TRIGGER = 2 * RADIUS + TAIL


def rolling(buf: np.ndarray) -> np.ndarray:
    """Hash of the TAIL bytes at every place, built by doubling."""
    h = (buf.astype(np.uint32) + np.uint32(1)) * np.uint32(0x9E3779B1)
    h ^= h >> np.uint32(15)
    step, mul = 1, 0x85EBCA6B
    while step < TAIL:
        h = h[:len(h) - step] * np.uint32(mul) + h[step:]
        step, mul = step * 2, mul * mul & 0xFFFFFFFF
    h ^= h >> np.uint32(16)
    h *= np.uint32(0x7FEB352D)
    h ^= h >> np.uint32(15)
    return h


def _least(a: np.ndarray, width: int) -> np.ndarray:
    step = 1
    while step * 2 <= width:
        a, step = np.minimum(a[:-step], a[step:]), step * 2
    return np.minimum(a[:len(a) - (width - step)], a[width - step:]) if step < width else a


def triggers(buf: np.ndarray) -> np.ndarray:
    """Starts of the trigger strings of a run of bytes."""
    if len(buf) < TRIGGER + 1:
        h = rolling(buf) if len(buf) >= TRIGGER else np.zeros(0, np.uint32)
        return np.zeros(int(len(h) == 2 * RADIUS + 1 and h[RADIUS] == h.min()), np.int64)
    h = rolling(buf)
    near = _least(h, 2 * RADIUS + 1)
    return np.flatnonzero(h[RADIUS:RADIUS + len(near)] == near)


def find_sites(texts, width: int = WIDTH):
    """(row, core, ctx, lo, hi) of every phrase occurrence that starts a window."""
    buf, off = values(texts)
    room = width - TRIGGER                       # a window may start so far before its trigger
    out = [[], [], [], [], []]
    for i, j in groups(off):
        at, raw = off[i], buf[off[i]:off[j]]
        data = memoryview(raw)
        begin, end = off[i:j] - at, off[i + 1:j + 1] - at
        a = triggers(raw)
        row = np.searchsorted(end, a, side="right")
        inside = a + TRIGGER <= end[row] if len(a) else np.zeros(0, bool)
        a, row = a[inside], row[inside]
        # one more phrase per document, from its last trigger to its end
        a = np.concatenate([a, end])
        row = np.concatenate([row, np.arange(j - i)])
        tail = np.concatenate([np.zeros(len(a) - (j - i), bool), np.ones(j - i, bool)])
        order = np.lexsort((tail, a, row))
        a, row, tail = a[order], row[order], tail[order]
        lo = np.empty(len(a), np.int64)
        lo[0] = 0
        lo[1:] = np.where(row[1:] == row[:-1], a[:-1] + 1, begin[row[1:]])
        lo = np.maximum(lo, begin[row])
        hi = np.minimum(a, end[row] - width)
        near = np.where(tail, hi + 1, np.maximum(lo, a - room))      # from here a window holds the trigger
        own = np.flatnonzero(near <= hi)
        x = xxhash.xxh3_64_intdigest
        core = [x(data[s:s + TRIGGER]) for s in a[own].tolist()]
        ctx = [x(data[s:e], 1) for s, e in zip(near[own].tolist(), (hi[own] + width).tolist())]
        bare = np.maximum(np.minimum(near - 1, hi) - lo + 1, 0)      # windows without a trigger
        s = ranges(lo, bare)
        core += [x(data[p:p + width], 2) for p in s.tolist()]
        ctx += [x(data[p:p + width], 3) for p in s.tolist()]
        r = np.concatenate([row[own], np.repeat(row, bare)])
        for put, val in zip(out, (r + i, signed(core), signed(ctx), np.concatenate([near[own], s]) - begin[r],
                                  np.concatenate([hi[own], s]) - begin[r])):
            put.append(val)
    return [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]


def window_hashes(text, starts: np.ndarray, width: int = WIDTH):
    data = memoryview(text)
    both = [xxhash.xxh3_128_intdigest(data[s:s + width]) for s in starts.tolist()]
    low = (1 << 64) - 1
    return signed([x >> 64 for x in both]), signed([x & low for x in both])


def _cut(batches):
    for b in batches:
        texts, spans = b.column("_b"), b.column("spans")
        kept, runs = [], []
        for i in range(b.num_rows):
            t = texts[i].as_buffer()
            if not spans[i].is_valid:
                kept.append(t.to_pybytes())
                runs.append([])
                continue
            s, e = covered(spans[i], WIDTH)
            s, e = s.tolist(), e.tolist()
            m = memoryview(t)
            kept.append(b"".join(m[p:q] for p, q in zip([0, *e], [*s, len(m)])))
            runs.append([{"start": p, "end": q} for p, q in zip(s, e)])
        keep = [c for c in b.schema.names if c not in ("_k", "_b", "spans")]
        yield pa.RecordBatch.from_arrays(
            [*(b.column(c) for c in keep), pa.array([len(texts[i].as_buffer()) for i in range(b.num_rows)], pa.int64()),
             pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
            names=[*keep, "n_bytes", "removed", "kept"])


def remove_repeated_strings(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Remove each byte covered by a WIDTH-byte string that also starts earlier.

    ``doc_id, carried, n_bytes, removed array<struct<start,end>>, kept binary``,
    one row per row of ``docs``. Earlier: smaller doc_id, or same document and
    earlier start; judged on the input. Null text is empty; texts under WIDTH
    bytes lose nothing. Documents whose doc_id is null come last; documents
    that share a doc_id are ordered by a hash of their text; rows that repeat
    both are one document and get equal answers. Other columns are ignored
    unless named in ``carry``; those come back inside the struct ``carried``,
    so no name can clash. ``kept`` is binary, as a cut may split a character.
    """
    spark = docs.sparkSession
    ship(spark)
    d = keyed(docs.select("doc_id", "text", F.struct(*[F.col(c) for c in carry]).alias("carried") if carry
                          else F.lit(0).alias("carried")))
    d = arrow_sized(d.select("_k", "doc_id", "carried", text_bytes().alias("_b")).where(F.col("_k").isNotNull()))
    spans = repeated_windows(d, find_sites, window_hashes, keep_first=True)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in d.schema if f.name in ("doc_id", "carried"))
    return (d.join(spans.hint("shuffle_hash"), "_k", "left")
            .mapInArrow(_cut, f"{kinds}, n_bytes long, removed array<struct<start:long,end:long>>, kept binary"))


def op1(spark, sf_dir):
    from kinrank.llm.common import table

    out = remove_repeated_strings(table(spark, sf_dir, "documents"))
    lost = F.aggregate("removed", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return out.select("doc_id", "n_bytes", lost.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))
