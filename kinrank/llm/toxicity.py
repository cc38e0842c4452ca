"""Operator 9, toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the mean of the vectors of its character n-grams (hashed into
BUCKETS), a document the mean of its words (one that occurs c times counting
1 + log c, so a repeated line says little more than the line), and a linear
softmax reads the label off that mean. Vectors and softmax are trained together, by gradients
through both means, in numpy. A misspelling nobody has seen shares most of its
n-grams, and so most of its vector, with the word it stands for.

The model is fitted on every word of at most TRAIN_ROWS labelled documents
(those whose doc_id hashes lowest, so the sample is the same whatever the
partitioning) of at most TRAIN_BYTES, whole texts; how much words count is
learned from rows left out. As the softmax is linear, a fitted model is one
number per n-gram, and scoring a document is averaging its words' numbers.
"""

from __future__ import annotations

import zlib
from itertools import accumulate
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinrank.llm.common import ROW_BATCH_BYTES, arrow_sized, lowest, ship

TRAIN_ROWS = 4000
TRAIN_BYTES = 48 << 20                # of text
BUCKETS = 1 << 18
GRAMS = (3, 4, 5)
DIMS = 8
EPOCHS = 80
PARTS = 3                             # parts of the rows that take turns to be left out
DECAY = 1e-5
RATE = 0.08
STRETCH = 30.0                        # a few words decide, so means are small
BLANK_WORDS = 50                      # words without a vector that every document has besides, so few words prove little
THRESHOLD = 0.3
FOLDS, HELD_OUT = 4, 2
TOGETHER = 20_000                     # words whose n-grams are hashed at a time
KNOWN = 200_000                       # words whose score a worker keeps


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of ``<word>`` and of the whole word, word after
    word, and how many each word has."""
    parts = [_grams(words[i:i + TOGETHER]) for i in range(0, len(words), TOGETHER)] or [_grams([])]
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    shown = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.array([len(w) + 2 for w in words], np.int64)
    begin = np.cumsum(size) - size
    word = np.repeat(np.arange(len(words)), size)
    found, owner = [], []
    code = shown * np.uint64(0x9E3779B97F4A7C15)
    part = np.zeros(len(shown), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        here = len(shown) - n + 1
        if here <= 0:
            break
        part = (part[:here] ^ (part[:here] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + code[n - 1:]
        if n in GRAMS:
            inside = word[:here] == word[n - 1:]
            found.append(part[inside] + np.uint64(n))
            owner.append(word[:here][inside])
    place = np.arange(len(shown)) - begin[word] + 1
    whole = (shown + np.uint64(0x632BE59B)) * place.astype(np.uint64) * np.uint64(0x94D049BB133111EB)
    whole ^= whole >> np.uint64(31)
    found.append(np.add.reduceat(whole * whole, begin) if len(words) else whole)
    owner.append(np.arange(len(words)))
    owner, mixed = np.concatenate(owner), np.concatenate(found) * np.uint64(0xD6E8FEB86659FD93)
    order = np.argsort(owner, kind="stable")
    return ((mixed[order] >> np.uint64(40)) % np.uint64(BUCKETS)).astype(np.int32), np.bincount(owner, minlength=len(words))


def words_of(text: str) -> list[str]:
    return text.lower().split()


def bags(texts) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """The texts' distinct words; then of each (text, word) met the text, the
    word and 1 + log of its occurrences there."""
    number: dict[str, int] = {}
    docs, words, counts = [], [], []
    for i, t in enumerate(texts):
        own = np.array([number.setdefault(w, len(number)) for w in words_of(t)], np.int32)
        word, count = np.unique(own, return_counts=True)
        docs.append(np.full(len(word), i, np.int32)), words.append(word), counts.append(count)
    if not docs:
        return [], np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0)
    return list(number), np.concatenate(docs), np.concatenate(words), 1.0 + np.log(np.concatenate(counts))


class Model:
    """One number per n-gram bucket, and the log odds of a text without words."""

    def __init__(self, weight: np.ndarray, bias: float):
        self.weight, self.bias = weight, bias

    def words(self, words: list[str]) -> np.ndarray:
        bucket, many = grams(words)
        return _word_means(self.weight, bucket, many)

    def word(self, word: str) -> float:
        return float(self.words([word])[0])

    def score(self, texts, known: dict[str, float]) -> np.ndarray:
        """Probability of label 1 for each text; ``known`` keeps words' numbers."""
        texts = list(texts)
        names, doc, word, share = bags(texts)
        if len(known) > KNOWN:
            known.clear()
        new = [w for w in names if w not in known]
        known.update(zip(new, self.words(new).tolist()))
        own = np.array([known[w] for w in names], float)
        total, size = np.bincount(doc, own[word] * share, len(texts)), np.bincount(doc, share, len(texts))
        return 1 / (1 + np.exp(-np.clip(self.bias + total / (size + BLANK_WORDS), -60, 60)))


def train(texts: list[str], labels: list[int], seed: int = 7) -> Model:
    """Fit on every word of whole texts. Without rows of both labels the model
    knows only the share of ones.

    A text without words gets the share of ones. Words met once let a model fit
    its own rows better than any others, so how much words count is learned from
    rows that it has not seen: the model is the mean of PARTS fits that leave out
    a part of the rows each, and a constant for every word is set so that as many
    rows reach THRESHOLD, each by the fit that left it out, as are ones (or few more).
    """
    y = np.array(labels, np.int64)
    ones = (y.sum() + 0.5) / (len(y) + 2.0)                              # under THRESHOLD where nothing is labelled
    bias = float(np.log(ones / (1 - ones)))
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(BUCKETS, np.float32), bias)
    names, doc, term, part = bags(texts)
    doc, term, part = doc.astype(np.int32), term.astype(np.int32), part.astype(np.float32)
    part = (STRETCH * part / (np.bincount(doc, part, len(y)) + BLANK_WORDS)[doc]).astype(np.float32)
    gram, many = grams(names)
    del names
    rows = doc, term, part, gram, many
    side = np.array([zlib.crc32(t.encode()) % PARTS for t in texts])      # copies of a text go together
    full = np.bincount(doc, part, len(y)) / STRETCH                          # near 1 for a long text, 0 for an empty one
    z, weight = np.zeros(len(y)), np.zeros(BUCKETS, np.float32)
    parts = [k for k in range(PARTS) if (side == k).any()]
    if len(parts) < 2 or any(len(set(y[side != k].tolist())) < 2 for k in parts):
        return Model(_fit(*rows, y, np.ones(len(y), bool), seed, bias), bias)
    for k in parts:
        own = _fit(*rows, y, side != k, seed, bias)
        z[side == k] = (np.bincount(doc, _word_means(own, gram, many)[term] * part, len(y)) / STRETCH)[side == k]
        weight += own / len(parts)
    return Model(weight + np.float32(_constant(bias + z, full, int(y.sum()))), bias)


def _word_means(weight: np.ndarray, gram: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Means of the weights of each word's n-grams."""
    if not len(many):
        return np.zeros(0)
    return np.add.reduceat(weight[gram], np.cumsum(many) - many) / many


def _fit(doc, term, part, gram, many, y, use, seed, bias) -> np.ndarray:
    """Weights of the buckets, learned from the rows in ``use``; what the
    offset learned beyond ``bias`` goes to every bucket alike.

    With two labels the softmax reads off one direction of the vectors, so all
    gradients are multiples of it: means are taken of numbers, not of vectors.
    """
    stay = use[doc]
    doc, term, part, rows = doc[stay], term[stay], part[stay], int(use.sum())
    met = np.bincount(term, minlength=len(many)) > 0
    gram, many = gram[np.repeat(met, many)], many[met]
    term = (np.cumsum(met, dtype=np.int32) - 1)[term]
    seen = np.bincount(gram, minlength=BUCKETS) > 0
    where = (np.cumsum(seen, dtype=np.int32) - 1)[gram]
    first, many = np.cumsum(many) - many, many.astype(np.float32)
    del stay, gram
    r = np.random.default_rng(seed)
    params = [r.normal(0, 0.3 / DIMS, (int(seen.sum()), DIMS)).astype(np.float32), r.normal(0, 0.3, (DIMS, 2)).astype(np.float32),
              np.array([0, bias], np.float32)]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    times = many.astype(np.int32)
    for step in range(1, EPOCHS + 1):
        e, out, own = params
        way = out[:, 1] - out[:, 0]
        words = np.add.reduceat(np.einsum("ij,j->i", e, way)[where], first) / many
        z = np.bincount(doc, words[term] * part, len(y)) + own[1] - own[0]
        dz = np.where(use, (1 / (1 + np.exp(-np.clip(z, -60, 60))) - y) / rows, 0.0)
        d_words = np.bincount(term, dz[doc] * part, len(many)) / many
        d_e = np.bincount(where, np.repeat(d_words, times), len(e)).astype(np.float32)
        d_out = np.einsum("ij,i->j", e, d_e)
        for i, g in enumerate((d_e[:, None] * way + DECAY * e, np.stack([-d_out, d_out], 1) + 1e-4 * out,
                               np.array([-dz.sum(), dz.sum()], np.float32))):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.99 * v[i] + 0.01 * g * g
            params[i] = params[i] - RATE * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.99 ** step)) + 1e-8)
    e, out, own = params
    weight = np.zeros(BUCKETS, np.float32)
    weight[seen] = STRETCH * (e @ (out[:, 1] - out[:, 0]))
    return weight + np.float32(own[1] - own[0] - bias)


def _constant(z: np.ndarray, full: np.ndarray, ones: int) -> float:
    """What each word must add for ``ones`` rows, and two deviations of that
    count more, to reach THRESHOLD (halfway to the next row)."""
    need = np.sort((np.log(THRESHOLD / (1 - THRESHOLD)) - z)[full > 0] / full[full > 0])
    if not len(need):
        return 0.0
    ones = min(ones + 2 * isqrt(ones), len(need))
    return float((need[ones - 1] + need[min(ones, len(need) - 1)]) / 2)


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learned: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, size: int = TRAIN_BYTES) -> Model:
    """A model of at most ``rows`` labelled documents that aren't held out, with
    at most ``size`` bytes of text: rows beyond are left out whole.

    Rows without a doc_id or with a label other than 0 and 1 teach nothing; of
    a doc_id labelled more than once the highest label counts, and of one with
    several texts the text that hashes lowest."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    picked = lowest(known, F.xxhash64("doc_id"), rows)
    text = F.coalesce("text", F.lit(""))
    of = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("_t")).join(F.broadcast(picked), "doc_id")
    sizes = of.groupBy("doc_id").agg(F.min_by(F.octet_length("text"), "_t").alias("n"), F.min("_t").alias("_t")).collect()
    sizes.sort(key=lambda r: r["_t"])
    within = [r["doc_id"] for r, n in zip(sizes, accumulate(r["n"] for r in sizes)) if n <= size]
    if len(within) < len(sizes):
        of = of.where(F.col("doc_id").isin(within))                      # `rows` at most
    found = of.groupBy("doc_id").agg(F.min_by("text", "_t").alias("text"), F.max("toxic").alias("toxic")).collect()
    found.sort(key=lambda r: (r["doc_id"], r["text"]))
    return train([r["text"] for r in found], [int(r["toxic"]) for r in found])


def score(docs: DataFrame, model: Model, carry: tuple[str, ...] = (), below: float | None = None) -> DataFrame:
    """``doc_id, carried, score``: how likely label 1 is for each whole text.

    One row per row of ``docs``, or per row scored under ``below``; null texts
    count as empty and get the share of ones. Only the text is looked at, and
    texts alike score alike, so repeated rows and ids change nothing. Columns
    named in ``carry`` come back in the struct ``carried``; others are ignored.
    """
    ship(docs.sparkSession)
    d = docs.select("doc_id", F.struct(*[F.col(c) for c in carry]).alias("carried") if carry else F.lit(0).alias("carried"),
                    *[F.col("text").alias("_t")][:"text" not in carry])                 # a carried text isn't sent twice
    sent = docs.sparkSession.sparkContext.broadcast((model.weight, model.bias))

    def run(batches):
        own, known = Model(*sent.value), {}
        for b in batches:
            texts = b.column("carried").field("text") if "text" in carry else b.column("_t")
            p = np.zeros(b.num_rows)
            for i in range(0, b.num_rows, 256):
                p[i:i + 256] = own.score((x.as_py() or "" for x in texts.slice(i, 256)), known)
            out = pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("carried"), pa.array(p)], names=["doc_id", "carried", "score"])
            yield out if below is None else out.filter(pa.array(p < below))

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in d.schema if f.name != "_t")
    return arrow_sized(d, size=ROW_BATCH_BYTES).mapInArrow(run, f"{kinds}, score double")


def op9(spark, sf_dir):
    from kinrank.llm.common import table

    docs = table(spark, sf_dir, "documents")
    out = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
