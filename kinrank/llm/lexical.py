"""Operator 12, ranked lexical search by sequential reads without random access (NRA).

The items are a stated query set, the documents an index. One pass over the
texts leaves a row for each document: its length and, for the terms that any
item has, their occurrences. From these rows come the corpus statistics, and
with them every occurrence's impact.

A task holds one batch of documents at a time as lists sorted by impact, a list
for each term. For an item it reads its terms' lists from the top, a stretch of
each in turn. A document met has a lower bound of its score, what was read of
it, and an upper bound, that and the next impact of every list it has not been
met in. Reading goes on until no document not met can reach the bar, and of
those met each is either under the bar or fully known. The bar is the score of
the task's k-th best document so far, and at least that of the k-th best of a
share of all documents (SHARE), ranked beforehand: a bar that the k-th best of
all can't be under. So few documents leave a task, and the first k of all
tasks' lists are the result.

Items are taken in blocks of at most BLOCK_BYTES of text, so what is broadcast
is bounded however many there are.
"""

from __future__ import annotations

from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinrank.llm.common import ROW_BATCH_BYTES, arrow_sized, materialize, ship, text_bytes
from kinrank.llm.decontaminate import LETTERS

TOP = 50
BLOCK_BYTES = 8 << 20                 # of items
SHARE = 16                            # one in so many documents sets the bar
STRETCH = 256                         # entries of a list read first; then twice as many each time
SEGMENT = 4 << 20                     # bytes of a text whose words are held at a time
INDEX_ROWS = 20_000                   # documents in a task's lists at a time
SEEN_BITS = 62


def terms_of(text: bytes):
    """Lists of the terms of a text, a stretch of it at a time."""
    clean = text.lower().translate(LETTERS)
    i, n = 0, len(clean)
    while i < n:
        j = clean.find(b" ", i + SEGMENT)
        j = n if j < 0 else j
        yield clean[i:j].split()
        i = j


def _blocks(items: DataFrame, size: int):
    """The items' numbers and ids, and the distinct terms of each, a block at a time."""
    b = items.select(F.col("item_id").alias("i"), text_bytes().alias("t"))
    total = b.agg(F.sum(F.length("t") + 64)).first()[0] or 0
    n = max(1, -(-total // size))
    for k in range(n):
        rows = b.where(F.pmod(F.xxhash64(F.coalesce(F.col("i").cast("string"), F.lit("")), "t"), F.lit(n)) == k).collect()
        vocab: dict[bytes, int] = {}
        lists = [sorted({vocab.setdefault(w, len(vocab)) for part in terms_of(bytes(r.t)) for w in part}) for r in rows]
        yield [r.i for r in rows], lists, vocab


def term_counts(docs: DataFrame, vocab: dict[bytes, int]) -> DataFrame:
    """``doc_id long, n long, terms array<int>, counts array<long>``: each row's
    terms with repeats, and the occurrences of the vocabulary's ones."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(vocab)

    def run(batches):
        get = sent.value.get
        size = len(sent.value)
        for b in batches:
            texts = b.column("_b")
            n, found, many = [], [], []
            for i in range(b.num_rows):
                total, own = 0, []
                for words in terms_of(texts[i].as_py()):
                    total += len(words)
                    own += [x for x in map(get, words) if x is not None]
                n.append(total)
                found += own
                many.append(len(own))
            code, count = np.unique(np.repeat(np.arange(len(n)), many) * size + np.array(found, np.int64), return_counts=True)
            row, term = np.divmod(code, max(1, size))
            off = pa.array(np.searchsorted(row, np.arange(len(n) + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.ListArray.from_arrays(off, pa.array(term.astype(np.int32))),
                 pa.ListArray.from_arrays(off, pa.array(count.astype(np.int64)))], names=["doc_id", "n", "terms", "counts"])

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("_b"))
    return arrow_sized(d, size=ROW_BATCH_BYTES).mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<long>")


class Index:
    """The lists of a batch of documents: (impact, document) of each term, highest first."""

    def __init__(self, n: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, weight: np.ndarray, texts: int, total: int):
        own = weight[term] > 0
        doc, term, tf = doc[own], term[own], tf[own]
        m = 100 - 50 + (50 * n * texts) // max(1, total)
        impact = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
        order = np.lexsort((-impact, term))
        self.size, self.doc, self.impact = len(n), doc[order], impact[order]
        self.start = np.searchsorted(term[order], np.arange(len(weight) + 1))

    def search(self, terms: list[int], k: int, bar: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and final scores: all that score ``bar`` (1 at least) or
        more and are among the first k here, equal scores included."""
        at, end = (self.start[np.array(terms, np.int64) + x] for x in (0, 1))
        at, end = at[at < end].copy(), end[at < end]
        low = np.zeros(self.size, np.int64)                             # lower bounds
        seen = np.zeros((-(-len(at) // SEEN_BITS) or 1, self.size), np.int64)
        among = np.zeros(self.size, bool)
        met = np.zeros(0, np.int64)                                     # documents that may yet belong
        bar, step, open_ = max(1, bar), STRETCH, True                   # open: documents not met may belong
        while True:
            fresh = []
            for t in np.flatnonzero(at < end).tolist():
                to = min(at[t] + step, end[t])
                doc, impact = self.doc[at[t]:to], self.impact[at[t]:to]
                at[t] = to
                if not open_:                                           # only what may belong is followed
                    keep = among[doc]
                    doc, impact = doc[keep], impact[keep]
                low[doc] += impact
                seen[t // SEEN_BITS, doc] |= 1 << t % SEEN_BITS
                fresh.append(doc)
            more = at < end
            front = np.where(more, self.impact[np.minimum(at, len(self.impact) - 1)] if len(self.impact) else 0, 0)
            rest = int(front.sum())
            if open_:
                doc = np.concatenate(fresh) if fresh else met
                doc = np.unique(doc[~among[doc]])
                among[doc] = True
                met = np.concatenate([met, doc])
            if len(met) >= k:
                bar = max(bar, int(np.partition(low[met], -k)[-k]))
            high = low[met] + rest
            alive = high >= bar
            among[met[~alive]] = False
            met, high = met[alive], high[alive]
            if not open_ or rest < bar:                                 # the bounds themselves: only unmet lists add
                for t in np.flatnonzero(more).tolist():
                    high = high - front[t] * (seen[t // SEEN_BITS, met] >> t % SEEN_BITS & 1)
                alive = high >= bar
                among[met[~alive]] = False
                met, high = met[alive], high[alive]
                open_ = open_ and rest >= bar
            if not open_ and (not len(met) or bool((high == low[met]).all())):
                return met, low[met]
            step *= 2


def _best(doc: np.ndarray, score: np.ndarray, null: np.ndarray, k: int):
    """The first k by score, then doc_id, null ones last."""
    order = np.lexsort((doc, null, -score))[:k]
    return doc[order], score[order], null[order]


def _search(counts: DataFrame, lists: list[list[int]], weight: np.ndarray, texts: int, total: int, k: int, bars: np.ndarray) -> DataFrame:
    """``item int, doc_id, score``: of each task, its first k documents of each item."""
    sent = counts.sparkSession.sparkContext.broadcast((lists, weight, bars))

    def run(batches):
        lists, weight, bars = sent.value
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))] * len(lists)
        for b in batches:
            terms, tf = b.column("terms"), b.column("counts")
            many = np.diff(terms.offsets.to_numpy())
            names = b.column("doc_id")
            null = names.is_null().to_numpy(zero_copy_only=False)
            names = names.fill_null(0).to_numpy()
            index = Index(b.column("n").to_numpy(), np.repeat(np.arange(b.num_rows), many), terms.flatten().to_numpy(),
                          tf.flatten().to_numpy(), weight, texts, total)
            for i, own in enumerate(lists):
                doc, score, no = best[i]
                met, found = index.search(own, k, max(int(bars[i]), int(score[-1]) if len(score) >= k else 0))
                if len(met):
                    best[i] = _best(np.concatenate([doc, names[met]]), np.concatenate([score, found]), np.concatenate([no, null[met]]), k)
        for i, (doc, score, no) in enumerate(best):
            if len(doc):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(doc), i, np.int32)), pa.array(doc, mask=no), pa.array(score)],
                                                 names=["item", "doc_id", "score"])

    return arrow_sized(counts, rows=INDEX_ROWS, size=ROW_BATCH_BYTES).mapInArrow(run, "item int, doc_id long, score long")


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def rank(docs: DataFrame, items: DataFrame, k: int = TOP, block: int = BLOCK_BYTES) -> DataFrame:
    """``item_id, rank int, doc_id long, score long``: the ``k`` best documents
    of each row of ``items`` with a score above 0.

    Null texts have no terms. Every row of either table is one of its own, so a
    repeated document is counted and ranked twice, and a repeated item has its
    list twice; equal scores stand by doc_id, null ones last. Empty tables give
    no rows; other columns are ignored. ``doc_id`` is a whole number.
    """
    spark = docs.sparkSession
    out = None
    for names, lists, vocab in _blocks(items, block):
        counts = materialize(term_counts(docs, vocab))
        stats = counts.agg(F.count(F.when(F.col("n") > 0, 1)).alias("texts"), F.sum("n").alias("total")).first()
        df = {r["t"]: r["df"] for r in counts.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect()}
        weight = np.zeros(len(vocab), np.int64)                        # of a block's terms: bounded by its bytes
        for t, n in df.items():
            weight[t] = floor(1000 * log((2 * stats["texts"] + 2) / (2 * n + 1)))
        texts, total = stats["texts"], stats["total"] or 0
        bars = np.zeros(len(lists), np.int64)
        part = counts.where(F.pmod(F.xxhash64("doc_id"), F.lit(SHARE)) == 0)
        for r in _first(_search(part, lists, weight, texts, total, k, bars), k).where(F.col("rank") == k).collect():
            bars[r["item"]] = r["score"]
        ids = spark.createDataFrame(pa.table({"item": pa.array(range(len(names)), pa.int32()),
                                              "item_id": pa.array(names, _arrow_kind(items))}))
        found = _first(_search(counts, lists, weight, texts, total, k, bars), k).join(F.broadcast(ids), "item")   # a row per item of a block
        found = found.select("item_id", "rank", "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    return out


def _arrow_kind(items: DataFrame):
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(items.schema["item_id"].dataType)


def op12(spark, sf_dir):
    from kinrank.llm.common import table

    return rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
