"""Operator 3, document fingerprints: one-permutation MinHash in Spark expressions.

Each shingle of five words is hashed once; the top bits of the hash choose one
of BINS bins and the rest is its value there. Sorting the hashes together with
one marker per bin, which is larger than any value, leaves the least value (or
the marker) at the front of each bin. Empty bins are filled by optimal
densification: each walks its own pseudo-random order of all bins and takes
the value of the first that has one, so any two sets make the same choice
wherever they agree. The LOW low-order bits of each bin are kept, packed into
longs; agreement is corrected for the share of bins that match by chance.

All of it is expressions inside one projection; the only shuffle brings each
document next to the one that follows it by doc_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinrank.llm.common import keyed

SHINGLE = 5
BINS = 256                            # a power of two
LOW = 4                               # bits kept of each bin
PER_LONG = 64 // LOW
VALUE_BITS = 64 - (BINS.bit_length() - 1)
MARK = (1 << VALUE_BITS) - 1
BUCKET_BYTES = 8 << 20
MOST_BUCKETS = 16_384


def _with(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), 0)


def _long(x: int) -> int:
    x &= (1 << 64) - 1
    return x - (1 << 64) if x >> 63 else x


def shingle_hashes(text: Column, shingle: int = SHINGLE) -> Column:
    """A hash for each run of ``shingle`` words (one of all words if fewer,
    none without words). Words end at blanks, tabs and line ends."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def runs(h):
        n = F.size(h)
        each = F.transform(F.sequence(F.lit(0), F.greatest(n - shingle, F.lit(0))),
                           lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(shingle)]))
        return (F.when(n == 0, F.array().cast("array<bigint>")).when(n < shingle, F.array(F.xxhash64(h))).otherwise(each))

    return _with(F.transform(words, lambda w: F.xxhash64(w)), runs)


def minima(hashes: Column) -> Column:
    """The least value of each bin, MARK where it is empty (in signed order of the bins)."""
    marks = F.array(*[F.lit(_long(b << VALUE_BITS | MARK)) for b in range(BINS)])

    def fronts(h):
        bin_of = lambda x: F.shiftrightunsigned(x, VALUE_BITS)
        first = F.filter(h, lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(h, i - 1))))
        return F.transform(first, lambda x: x.bitwiseAND(MARK))

    return _with(F.sort_array(F.concat(hashes, marks)), fronts)


def densified(bins: Column) -> Column:
    """Empty bins take the value of the first bin with one in their own order:
    start + t * step (mod BINS), step odd, which meets every bin."""
    start = F.array(*[F.lit((b * 0x9E3779B1 >> 7) % BINS) for b in range(BINS)])
    step = F.array(*[F.lit(((b + 1) * 0x85EBCA6B >> 9) % BINS | 1) for b in range(BINS)])

    def fill(v):
        def find(i, a, b):
            at = F.transform(F.sequence(F.lit(a), F.lit(b - 1)),
                             lambda t: F.get(v, (F.get(start, i) + t * F.get(step, i)).bitwiseAND(BINS - 1)))
            return F.get(F.filter(at, lambda x: x != MARK), 0)

        return F.transform(v, lambda x, i: F.when(x != MARK, x).otherwise(
            F.coalesce(find(i, 0, 16), find(i, 16, 64), find(i, 64, BINS), F.lit(0).cast("long"))))

    return _with(bins, fill)


def fingerprint(text: Column) -> Column:
    """array<long> with the packed low-order bits; all zero without words."""
    def pack(v):
        return F.transform(F.sequence(F.lit(0), F.lit(BINS // PER_LONG - 1)), lambda g: F.aggregate(
            F.slice(v, g * PER_LONG + 1, F.lit(PER_LONG)), F.lit(0).cast("long"),
            lambda a, x: F.shiftleft(a, LOW).bitwiseOR(x.bitwiseAND((1 << LOW) - 1))))

    zero = F.array(*[F.lit(0).cast("long")] * (BINS // PER_LONG))
    return _with(shingle_hashes(text), lambda h: F.when(F.size(h) == 0, zero).otherwise(
        _with(densified(minima(h)), pack)))


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles, 0 to 1: matching bins, less those
    that match by chance."""
    ones = _long(sum(1 << i for i in range(0, 64, LOW)))

    def differing(x, y):
        z = x.bitwiseXOR(y)
        z = z.bitwiseOR(F.shiftrightunsigned(z, 1))
        z = z.bitwiseOR(F.shiftrightunsigned(z, 2))
        return F.bit_count(z.bitwiseAND(ones))

    same = F.lit(BINS) - F.aggregate(F.zip_with(a, b, differing), F.lit(0), lambda s, x: s + x)
    chance = 1.0 / (1 << LOW)
    return F.greatest(F.lit(0.0), (same / F.lit(float(BINS)) - chance) / (1 - chance))


def as_hex(fp: Column) -> Column:
    return F.array_join(F.transform(fp, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def _bucket_of(key: Column, bounds: list[int]) -> Column:
    """How many of the sorted ``bounds`` are at most ``key``, in two steps."""
    if not bounds:
        return F.lit(0)
    wide = max(1, int(len(bounds) ** 0.5))
    parts = [bounds[i:i + wide] for i in range(0, len(bounds), wide)]
    heads = F.array(*[F.lit(p[0]) for p in parts])
    lists = F.array(*[F.array(*[F.lit(x) for x in p]) for p in parts])
    part = F.size(F.filter(heads, lambda x: x <= key))
    return F.when(part == 0, F.lit(0)).otherwise(
        (part - 1) * wide + F.size(F.filter(F.get(lists, part - 1), lambda x: x <= key)))


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``docs`` (with ``_k``) and, as ``next_*``, ``columns`` of the row that
    follows by ``_k``; after the last row the first.

    Rows are dealt by ranges of ``_k`` (bounds from its quantiles, at most
    MOST_BUCKETS); the first row of each range also goes, marked, to the end
    of the range before it, so no window needs to see more than one range.
    """
    size = docs.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = int(min(MOST_BUCKETS, max(1, size // BUCKET_BYTES)))
    bounds = []
    if n > 1:
        found = docs.agg(F.percentile_approx("_k", [i / n for i in range(1, n)], max(10_000, 10 * n))).first()[0]
        bounds = sorted(set(found or []))
    d = docs.withColumn("_bucket", _bucket_of(F.col("_k"), bounds))
    ends = d.groupBy("_bucket").agg(F.min("_k").alias("_first"))                # a row a bucket
    every = Window.orderBy("_bucket")
    before = F.coalesce(F.lag("_bucket").over(every), F.max("_bucket").over(
        every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    ends = F.broadcast(ends.withColumn("_before", before))
    here = F.struct(F.col("_bucket").alias("bucket"), F.lit(False).alias("copy"))
    back = F.struct(F.col("_before").alias("bucket"), F.lit(True).alias("copy"))
    dealt = (d.join(ends, "_bucket")
             .withColumn("_to", F.explode(F.when(F.col("_k") == F.col("_first"), F.array(here, back)).otherwise(F.array(here))))
             .select(*docs.columns, F.col("_to.bucket").alias("_bucket"), F.col("_to.copy").alias("_copy")))
    w = Window.partitionBy("_bucket").orderBy("_copy", "_k")
    return (dealt.select(*docs.columns, "_copy", *[F.lead(c).over(w).alias(f"next_{c}") for c in columns])
            .where(~F.col("_copy")).drop("_copy"))


def fingerprint_pairs(docs: DataFrame) -> DataFrame:
    """Each text, its edit by the next document, and how alike fingerprints are.

    ``doc_id, n_chars, edited string, fp, edited_fp array<long>, near_edited,
    near_next``, one row per row of ``docs``. Null texts are empty; a text
    without words has fingerprint zero; fewer than five words are one shingle.
    Rows follow by doc_id, nulls last, then by a hash of the text; a single
    row is followed by itself. Other columns are ignored.
    """
    d = keyed(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    d = d.withColumn("fp", fingerprint(F.col("text")))
    e = with_next(d, ["text", "fp"])
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    e = e.withColumn("n_chars", n.cast("long")).withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut)))
    e = e.withColumn("edited_fp", fingerprint(F.col("edited")))
    return e.select("doc_id", "n_chars", "edited", "fp", "edited_fp", likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
                    likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))


def op3(spark, sf_dir):
    from kinrank.llm.common import table

    out = fingerprint_pairs(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                      as_hex(F.col("fp")).alias("fingerprint"), as_hex(F.col("edited_fp")).alias("edited_fingerprint"),
                      "near_edited", "near_next")
