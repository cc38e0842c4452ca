"""Operator 5, best-fit packing by exact complements.

Documents become pieces of at most ``size`` tokens, and pieces of one length
are alike, so the plan is made on the table of lengths and their counts (at
most ``size`` rows, whatever the corpus). Taking lengths from the largest
down, the gap that a piece leaves is filled exactly: by one length, by the sum
of two, or by the sum of three, as far as pieces are at hand. What no
combination completes is placed best-fit, again many sequences at a time.

The plan is a list of segments: so many pieces of a length, from that rank on,
go to sequences from that number on, at that offset. Pieces are ranked within
their length in two steps (inside a salt, then by the salts' counts), so a
length that a third of all pieces share is never one task, and a join on
(length, block of ranks) finds each piece's segment.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinrank.llm.common import ROW_BATCH_BYTES, arrow_sized, groups, materialize, ship, text_bytes, values

SIZE = 2048
END = 0
SALT_ROWS = 100_000                   # pieces ranked in one sort, about


Segment = tuple[int, int, int, int, int]


def plan(counts: dict[int, int], size: int = SIZE) -> list[Segment]:
    """Segments (length, first rank, pieces, first sequence, offset) that place
    ``counts[length]`` pieces of each length into sequences of ``size``.

    Small pieces spent in threes can be missed later, so the plan is also made
    with complements of two lengths, of one and of none, and the fewest
    sequences win."""
    plans = [_plan(counts, size, most) for most in (3, 2, 1, 0)]
    return min(plans, key=lambda p: max((first + many for _, _, many, first, _ in p), default=0))


def _plan(counts: dict[int, int], size: int, most: int) -> list[Segment]:
    left = {n: c for n, c in counts.items() if c > 0}
    have = np.zeros(size + 1, np.int64)              # the same as an array
    for n, c in left.items():
        have[n] = c
    used: dict[int, int] = defaultdict(int)
    out: list[Segment] = []
    sequences = 0

    def take(lengths: list[int], times: int, first: int, offset: int) -> None:
        for n in lengths:
            out.append((n, used[n], times, first, offset))
            used[n] += times
            left[n] -= times
            have[n] -= times
            offset += n

    def times(lengths: list[int]) -> int:
        return min(left.get(n, 0) // lengths.count(n) for n in lengths)

    for n in sorted(left, reverse=True):
        gap = size - n
        if gap == 0:
            first, sequences = sequences, sequences + left[n]
            take([n], left[n], first, 0)
            continue
        for combo in _complements(n, gap, have) if most else ():
            if len(combo) > most + 1:
                break
            k = times(combo)
            if k > 0:
                first, sequences = sequences, sequences + k
                take(combo, k, first, 0)
            if not left[n]:
                break
    rest = sorted(((n, c) for n, c in left.items() if c), reverse=True)
    # best fit on what is left: groups of equal sequences by the room they have
    rooms: dict[int, list[tuple[int, int]]] = defaultdict(list)      # room -> (first sequence, how many)
    order: list[int] = []
    for n, c in rest:
        while c:
            at = bisect_left(order, n)
            if at == len(order):
                each = size // n                     # open sequences that hold as many as fit
                k = max(1, c // each) if c >= each else 1
                each = min(each, c)
                first, sequences = sequences, sequences + k
                take([n] * each, k, first, 0)
                c -= each * k
                _put(rooms, order, size - n * each, first, k)
                continue
            room = order[at]
            first, many = rooms[room].pop()
            if not rooms[room]:
                order.pop(at)
            k = min(c, many)
            take([n], k, first, size - room)
            c -= k
            _put(rooms, order, room - n, first, k)
            if many > k:
                _put(rooms, order, room, first + k, many - k)
    return out


def _put(rooms, order, room, first, many):
    if room <= 0 or not many:
        return
    if not rooms[room]:
        insort(order, room)
    rooms[room].append((first, many))


def _complements(n: int, gap: int, have: np.ndarray):
    """Combinations [n, ...] that add up to the size exactly: one length, two,
    three, of lengths still on offer in ``have``, which the caller keeps."""
    if have[gap]:
        yield [n, gap]
    at = np.flatnonzero(have[:gap])
    pair = at[(at <= gap // 2) & (have[gap - at] > 0)]
    for b in pair[::-1].tolist():                                    # nearest to halves first
        if not have[n]:
            return
        if have[b] and have[gap - b]:
            yield [n, gap - b, b]
    for b in at[::-1].tolist():                                      # the largest of three
        if not have[n] or 3 * b < gap:
            return
        if not have[b]:
            continue
        two = gap - b
        c = at[at <= two // 2]
        c = c[(two - c <= b) & (have[c] > 0) & (have[two - c] > 0)]
        for x in c[::-1].tolist():
            if not have[n] or not have[b]:
                break
            if have[x] and have[two - x]:
                yield [n, b, two - x, x]


def pieces_of(docs: DataFrame, path: str, size: int = SIZE, with_ids: bool = True) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32[, ids]``: the documents' token
    ids with the end id, cut where longer than ``size``."""
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        from kinrank.llm.tokens import encoder

        enc = encoder(path)
        for b in batches:
            buf, off = values(b.column("_b"))
            for i, j in groups(off):
                ids, count = enc.encode(buf[off[i]:off[j]], off[i:j + 1] - off[i])
                row, piece, crc, length, own = [], [], [], [], []
                at = 0
                for r, n in enumerate(count.tolist()):
                    x = np.append(ids[at:at + n], np.uint32(END)).astype("<u4")
                    at += n
                    for p, s in enumerate(range(0, n + 1, size)):
                        part = x[s:s + size].tobytes()
                        row.append(i + r)
                        piece.append(p)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        own.append(part)
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                cols = [b.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                        pa.array([p * size for p in piece], pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                if with_ids:
                    names, cols = [*names, "ids"], [*cols, pa.array(own, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return arrow_sized(docs.select("doc_id", text_bytes().alias("_b")), size=ROW_BATCH_BYTES).mapInArrow(run, schema)


def pack(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; any further columns stay.

    Needs doc_id, piece, length (1 to ``size``) and ids_crc32. Null and
    repeated ids and repeated rows are pieces like any other; an empty table
    gives no rows."""
    spark = pieces.sparkSession
    n = pieces.count()
    salts = max(1, -(-n // SALT_ROWS))
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    tally = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1))
    base = tally.withColumn("_base", F.coalesce(before, F.lit(0))).select("length", "_salt", "_base")
    counts = {r["length"]: r["n"] for r in tally.groupBy("length").agg(F.sum("n").alias("n")).collect()}   # at most `size` rows
    # a segment is cut at multiples of SALT_ROWS ranks, so that a block of ranks finds it by equality
    rows = []
    for length, rank, many, first, offset in plan(counts, size):
        while many:
            k = min(many, SALT_ROWS - rank % SALT_ROWS)
            rows.append((length, rank // SALT_ROWS, rank, rank + k, first, offset))
            rank, first, many = rank + k, first + k, many - k
    segments = spark.createDataFrame(rows, "length long, _block long, _from long, _to long, _first long, _at long")
    order = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (salted.withColumn("_in", F.row_number().over(order) - 1).join(base, ["length", "_salt"])
              .withColumn("_rank", F.col("_base") + F.col("_in"))
              .withColumn("_block", F.floor(F.col("_rank") / SALT_ROWS)))
    return (ranked.join(segments, ["length", "_block"]).where("_rank >= _from and _rank < _to")
            .withColumn("sequence_id", F.col("_first") + F.col("_rank") - F.col("_from"))
            .withColumn("offset", F.col("_at"))
            .select(*pieces.columns, "sequence_id", "offset"))


def pack_documents(docs: DataFrame, path: str, size: int = SIZE, with_ids: bool = False) -> DataFrame:
    """Tokenise and pack; one row per piece. Null texts are empty documents of
    one end id. The pieces are written once, as the plan needs their counts."""
    return pack(materialize(pieces_of(docs, path, size, with_ids)), size)


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op5(spark, sf_dir):
    from kinrank.llm.common import table

    return pack_documents(table(spark, sf_dir, "documents"), vocabulary())
