"""Operator 2, benchmark decontamination on suffix arrays of the training texts.

The training texts are cut into shards, one per Arrow batch of whole documents.
A shard's words become numbers, and its suffix array holds the places where a
match of two words at least can begin (a place whose next two words follow each
other nowhere in the benchmark is never found by any search, so it is left
out), sorted by the following words up to the window's length. Every
suffix of every benchmark item is then looked up by binary search in every
shard; neighbouring finds of one item and one alignment join into the longest
verbatim matches, with their places.

The benchmark is a stated query set. It is read in blocks of at most
BLOCK_BYTES of text (an item is never split); every batch of documents meets
one block after the other, within its task and without a shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinrank.llm.common import ROW_BATCH_BYTES, arrow_sized, ranges, ship, text_bytes

WINDOW = 10
BLOCK_BYTES = 8 << 20

LETTERS = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
BOUND = 0xFFFFFFFF
ALONE = -1                            # beside an item's first or last word; ALONE - 1 beside a text's


def words_of(text: bytes) -> list[bytes]:
    """Lower-case A-Z; words are runs of digits, letters and non-ASCII characters."""
    return text.lower().translate(LETTERS).split()


def _keys(seq: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """The ``width`` numbers from each place on, as strings that sort alike."""
    cols = np.empty((len(at), width), ">u4")
    for i in range(width):
        cols[:, i] = seq[at + i]
    return cols.view(f"S{4 * width}").ravel()


class Suffixes:
    """The suffixes of a block of items: what a shard is searched for.

    Numbers: 0 ends a text, 1 is a word that no item has, others are words."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.window, self.names = window, [i for i, _ in items]
        self.vocab: dict[bytes, int] = {}
        lists = [[self.vocab.setdefault(w, len(self.vocab) + 2) for w in words_of(t)] for _, t in items]
        places: dict[tuple, list[tuple[int, int]]] = {}
        pairs = set()
        for i, ids in enumerate(lists):
            if ids:
                for j in range(max(1, len(ids) - window + 1)):
                    places.setdefault(tuple(ids[j:j + window]), []).append((i, j))
                pairs.update(zip(ids, ids[1:]))
        self.size = size = len(self.vocab) + 4
        self.single = np.zeros(size, bool)                     # words that are a whole item
        self.single[[w[0] for w in places if len(w) == 1]] = True
        self.pairs = np.array(sorted(a * size + b for a, b in pairs), np.int64)
        self.length = np.array([len(w) for w in places], np.int64)
        low = np.zeros((len(places), window), ">u4")
        high = np.full((len(places), window), BOUND, ">u4")
        for r, w in enumerate(places):
            low[r, :len(w)] = high[r, :len(w)] = w
        kind = f"S{4 * window}"
        self.low, self.high = low.view(kind).ravel(), high.view(kind).ravel()
        self.low_is_high = self.length == window
        flat = [(i, j) for v in places.values() for i, j in v]
        self.count = np.array([len(v) for v in places.values()], np.int64)
        self.begin = np.cumsum(self.count) - self.count
        self.item = np.array([i for i, _ in flat], np.int64)
        self.place = np.array([j for _, j in flat], np.int64)
        # the words beside each place, ALONE where there is none
        sizes = np.repeat(self.length, self.count)
        self.before = np.array([lists[i][j - 1] if j else ALONE for i, j in flat], np.int64)
        self.after = np.array([lists[i][j + n] if j + n < len(lists[i]) else ALONE for (i, j), n in zip(flat, sizes.tolist())], np.int64)

    def search(self, texts) -> tuple[list[int], list[int], list[list[dict]]]:
        """Of a shard's texts the word counts, the words inside any window, and
        the longest matches: one for each run of one alignment with an item."""
        get, size = self.vocab.get, self.size
        seq, count = [], []
        for t in texts:
            w = words_of(t)
            seq += [get(x, 1) for x in w]
            seq.append(0)
            count.append(len(w))
        seq = np.array(seq + [0] * self.window, np.int64)
        matches: list[list[dict]] = [[] for _ in count]
        if not len(self.length):
            return count, [0] * len(count), matches
        begin = np.cumsum(np.array(count) + 1) - np.array(count) - 1
        at = np.flatnonzero(seq[:-1] > 1)
        code = seq[at] * size + seq[at + 1]
        spot = np.searchsorted(self.pairs, code)
        known = np.zeros(len(at), bool)
        if len(self.pairs):
            known = self.pairs[np.minimum(spot, len(self.pairs) - 1)] == code
        at = at[known | self.single[seq[at]]]
        keys = _keys(seq, at, self.window)
        order = np.argsort(keys, kind="stable")                # the shard's suffix array
        at, keys = at[order], keys[order]
        lo = np.searchsorted(keys, self.low, "left")
        hi = np.where(self.low_is_high, np.searchsorted(keys, self.low, "right"), np.searchsorted(keys, self.high, "left"))
        found = hi - lo
        window = np.repeat(np.arange(len(found)), found)      # of each find
        where = at[ranges(lo, found)]
        width = self.length[window]
        covered = np.zeros(len(seq) + 1, np.int64)             # each find once, whatever the items' places
        np.add.at(covered, where, 1)
        np.add.at(covered, where + width, -1)
        inside = np.concatenate([[0], np.cumsum(np.cumsum(covered)[:-1] > 0)])
        many = np.array(count, np.int64)
        hits = (inside[begin + many] - inside[begin]).tolist()
        # a match begins where the words before differ, and ends where those after do
        alone = np.concatenate([[True], (seq[:-1] < 2)])
        before = np.where(alone[where], ALONE - 1, seq[where - 1])
        past = seq[where + width]
        after = np.where(past < 2, ALONE - 1, past)
        first = self._unlike(window, where, before, self.before)
        last = self._unlike(window, where, after, self.after)
        row, end_row = (np.searchsorted(begin, x[0], "right") - 1 for x in (first, last))
        one = np.lexsort((first[0], first[2] - first[0], first[1], row))
        two = np.lexsort((last[0], last[2] - last[0], last[1], end_row))
        start, item, place = (x[one] for x in first[:3])
        length = (last[0] + last[3])[two] - start              # starts and ends of an alignment alternate
        for r, i, p, w, n in zip(row[one].tolist(), item.tolist(), place.tolist(), (start - begin[row[one]]).tolist(), length.tolist()):
            matches[r].append({"item_id": self.names[i], "item_start": p, "doc_start": w, "n_words": n})
        return count, hits, matches

    def _unlike(self, window, where, beside, own):
        """The pairs of a find and an item's place of the same window whose
        words ``beside`` them differ: (where, item, place, words of the window).
        Both are sorted by that word, so pairs alike are skipped and not made."""
        order = np.lexsort((beside, window))
        window, where, code = window[order], where[order], (window * self.size + beside + 2)[order]
        found = np.bincount(window, minlength=len(self.length))
        begin = np.cumsum(found) - found
        of = np.repeat(np.arange(len(self.length)), self.count)
        use = np.flatnonzero(found[of] > 0)
        of = of[use]
        same = of * self.size + own[use] + 2
        lo, hi = begin[of], begin[of] + found[of]
        a, b = np.searchsorted(code, same, "left"), np.searchsorted(code, same, "right")
        spot = np.concatenate([use, use])
        at, n = np.concatenate([lo, b]), np.concatenate([a - lo, hi - b])
        pick, spot = ranges(at, n), np.repeat(spot, n)
        return where[pick], self.item[spot], self.place[spot], self.length[window[pick]]


MATCH = "struct<item_id:string,item_start:long,doc_start:long,n_words:long>"


def _arrow_match():
    return pa.list_(pa.struct([("item_id", pa.string()), ("item_start", pa.int64()), ("doc_start", pa.int64()),
                               ("n_words", pa.int64())]))


def blocks(benchmark: DataFrame, window: int = WINDOW, size: int = BLOCK_BYTES) -> list:
    """The benchmark's suffixes, a broadcast for each block of items: files on
    the machines' disks, so that neither the driver nor a task holds more than
    one. An item whose id is null takes part under the empty string; null texts
    have no words."""
    sc = benchmark.sparkSession.sparkContext
    b = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("i"), text_bytes().alias("t"))
    total = b.agg(F.sum(F.length("t") + 64)).first()[0] or 0
    n = max(1, -(-total // size))
    return [sc.broadcast(Suffixes([(r.i, bytes(r.t)) for r in b.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k).collect()], window))
            for k in range(n)]


def find_contamination(docs: DataFrame, benchmark: DataFrame, carry: tuple[str, ...] = (), window: int = WINDOW,
                       size: int = BLOCK_BYTES, clean_only: bool = False) -> DataFrame:
    """``doc_id, carried, n_words, n_hit, matches, contaminated``, one row per
    row of ``docs`` (``clean_only``: per row without hits); ``matches`` are the
    longest verbatim matches of ``window`` words at least (or of a whole shorter
    item), with their places in words, one for each run of one alignment: texts
    that repeat themselves N and M times have about N + M of them, not N x M.

    Null texts have no words. Rows are judged alone, so repeated rows, null or
    repeated ids and ties change nothing; an empty benchmark hits nothing. A
    very long text is a shard of its own. Columns named in ``carry`` come back
    in ``carried``; others are ignored.
    """
    ship(docs.sparkSession)
    d = docs.select("doc_id", F.struct(*[F.col(c) for c in carry]).alias("carried") if carry else F.lit(0).alias("carried"),
                    *[F.col("text").alias("_t")][:"text" not in carry])                 # a carried text isn't sent twice
    sent = blocks(benchmark, window, size)

    def search(batches):
        for b in batches:
            texts = b.column("carried").field("text") if "text" in carry else b.column("_t")
            n, hit, found = [], np.zeros(b.num_rows, np.int64), [[] for _ in range(b.num_rows)]
            for block in sent:
                own = block.value
                n, hits, matches = own.search((x.as_py() or "").encode() for x in texts)
                hit = np.maximum(hit, hits) if len(sent) == 1 else hit
                found = [x + y for x, y in zip(found, matches)]
                if len(sent) > 1:                                       # the next block takes this one's place
                    vars(block).pop("_value", None)
            if len(sent) > 1:
                hit = np.array([hit_words(m) for m in found], np.int64)
            out = pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("carried"), pa.array(n, pa.int64()), pa.array(hit, pa.int64()), pa.array(found, _arrow_match())],
                names=["doc_id", "carried", "n_words", "n_hit", "matches"])
            yield out.filter(pa.array(hit == 0)) if clean_only else out

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in d.schema if f.name != "_t")
    return (arrow_sized(d, size=ROW_BATCH_BYTES).mapInArrow(search, f"{kinds}, n_words long, n_hit long, matches array<{MATCH}>")
            .withColumn("contaminated", F.col("n_hit") > 0))


def hit_words(matches: list[dict]) -> int:
    """Words inside any match."""
    total, end = 0, 0
    for s, n in sorted((m["doc_start"], m["n_words"]) for m in matches):
        total += max(0, s + n - max(s, end))
        end = max(end, s + n)
    return total


def op2(spark, sf_dir):
    from kinrank.llm.common import table

    out = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    items = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item_id"])))
    return out.select("doc_id", "n_words", "n_hit", F.size(items).cast("long").alias("n_items"),
                      F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"), "contaminated")
