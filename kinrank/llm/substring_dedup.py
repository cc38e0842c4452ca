"""Operator 10, substring dedup on difference-cover anchors.

COVER is a perfect difference set modulo PERIOD: for any two places in the
corpus some shift below PERIOD brings both onto places whose number modulo
PERIOD is in COVER. Strings of CORE words are hashed at those places only, five
of every 21 words. As PERIOD - 1 + CORE = WIDTH, two equal windows of WIDTH
words, however they lie, share an aligned anchor inside them; the anchor's
match is then extended to the windows around it: equal contexts at once, the
rest window by window (``repeats``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinrank.llm.common import arrow_sized, keyed, ship, signed, text_bytes
from kinrank.llm.repeats import covered, repeated_windows

WIDTH = 35
PERIOD, COVER = 21, (0, 1, 4, 14, 16)
CORE = WIDTH - PERIOD + 1


def words_of(text) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words joined by single spaces, and where each starts and ends."""
    norm = b" ".join(bytes(text).split())            # bytes.split: \x20 and \x09-\x0D
    gaps = np.flatnonzero(np.frombuffer(norm, np.uint8) == 32)
    if not norm:
        return norm, gaps, gaps
    return norm, np.concatenate([[0], gaps + 1]), np.append(gaps, len(norm))


def find_sites(texts):
    out = [[], [], [], [], []]
    x = xxhash.xxh3_64_intdigest
    residues = np.array(COVER)
    for i in range(len(texts)):
        norm, first, last = words_of(texts[i].as_buffer())
        n = len(first)
        if n < WIDTH:
            continue
        q = (np.arange(0, n, PERIOD)[:, None] + residues).ravel()
        q = q[q + CORE <= n]
        lo, hi = np.maximum(q - PERIOD + 1, 0), np.minimum(q, n - WIDTH)
        data = memoryview(norm)
        core = [x(data[s:e]) for s, e in zip(first[q].tolist(), last[q + CORE - 1].tolist())]
        # equal texts around an anchor that sits elsewhere in them are another context
        ctx = [x(data[s:e], d) for s, e, d in zip(first[lo].tolist(), last[hi + WIDTH - 1].tolist(), (q - lo + 1).tolist())]
        for put, val in zip(out, (np.full(len(q), i), signed(core), signed(ctx), lo, hi)):
            put.append(val)
    return [np.concatenate(v) if v else np.zeros(0, np.int64) for v in out]


def window_hashes(text, starts: np.ndarray):
    norm, first, last = words_of(text)
    data, low = memoryview(norm), (1 << 64) - 1
    both = [xxhash.xxh3_128_intdigest(data[s:e])
            for s, e in zip(first[starts].tolist(), last[starts + WIDTH - 1].tolist())]
    return signed([v >> 64 for v in both]), signed([v & low for v in both])


def _cut(batches):
    for b in batches:
        texts, spans = b.column("_b"), b.column("spans")
        kept, runs, count, cleaned = [], [], [], []
        for i in range(b.num_rows):
            norm, first, last = words_of(texts[i].as_buffer())
            count.append(len(first))
            if not spans[i].is_valid:
                kept.append(norm)
                cleaned.append(texts[i].as_py())
                runs.append([])
                continue
            s, e = covered(spans[i], WIDTH)
            runs.append([{"start": p, "end": q} for p, q in zip(s.tolist(), e.tolist())])
            stay = [norm[first[p]:last[q - 1]] for p, q in zip([0, *e.tolist()], [*s.tolist(), len(first)]) if p < q]
            kept.append(b" ".join(stay))
            cleaned.append(kept[-1])
        keep = [c for c in b.schema.names if c not in ("_k", "_b", "spans")]
        yield pa.RecordBatch.from_arrays(
            [*(b.column(c) for c in keep), pa.array(count, pa.int64()),
             pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
             pa.array(kept, pa.binary()).cast(pa.string()), pa.array(cleaned, pa.binary()).cast(pa.string())],
            names=[*keep, "n_words", "removed", "kept", "cleaned"])


def remove_repeated_passages(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Remove each word covered by a WIDTH-word window that starts anywhere else too.

    ``doc_id, carried, n_words, removed array<struct<start,end>> (word numbers),
    kept string (the words left, joined by one space), cleaned string`` (the
    same where words went, else the text as it was), one row per row of
    ``docs``. Every place of a repeated window loses its words, the first one
    too. Null text has no words; texts of fewer than WIDTH words lose nothing.
    Rows that repeat both doc_id and text are one document listed twice and
    don't count as each other's repeats; equal texts under different ids do,
    as do different texts that share an id or have none. Columns named in
    ``carry`` come back in the struct ``carried``; others are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    d = keyed(docs.select("doc_id", "text", F.struct(*[F.col(c) for c in carry]).alias("carried") if carry
                          else F.lit(0).alias("carried")))
    d = arrow_sized(d.select("_k", "doc_id", "carried", text_bytes().alias("_b")).where(F.col("_k").isNotNull()))
    spans = repeated_windows(d, find_sites, window_hashes, keep_first=False)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in d.schema if f.name in ("doc_id", "carried"))
    return (d.join(spans.hint("shuffle_hash"), "_k", "left")
            .mapInArrow(_cut, f"{kinds}, n_words long, removed array<struct<start:long,end:long>>, kept string, cleaned string"))


def op10(spark, sf_dir):
    from kinrank.llm.common import table

    out = remove_repeated_passages(table(spark, sf_dir, "documents"))
    lost = F.aggregate("removed", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return out.select("doc_id", "n_words", lost.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))
