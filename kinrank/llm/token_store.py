"""Operator 8, token ids in binary files of directly addressable codes.

An id is cut into chunks of eight bits, lowest first. Level 0 has a chunk of
every id; a bitmap says which ids go on, and the next level has the next chunk
of those only, and so on. A rank directory holds, for every 512 places, how
many bits of the bitmap are set before them; with it, place i of a level leads
to its place in the next, so any id is read without decoding what precedes it.

A file image holds the ids of some documents, one after the other. Images are
the rows of a Parquet folder (any store that Spark writes to), in ascending
doc_id order by (part, seq). Each image also has where its documents start,
counted within its part; the parts' own starts are the sums of a table with a
row per part.

Layout of an image, little-endian: magic ``DAC8``; u32 documents; u64 ids; u8
levels; u64 starts of the documents and of the end; then for each level u64
places, the chunks, the bitmap (low bit first), the directory (u32).
"""

from __future__ import annotations

import struct
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinrank.llm.common import arrow_sized, groups, keyed, ship, text_bytes, values
from kinrank.session import ensure_checkpoint_dir, parallelism

MAGIC = b"DAC8"
CHUNK = 8
STEP = 512                            # places per entry of the rank directory
END = 0


def encode(ids: np.ndarray, starts: np.ndarray) -> bytes:
    """The file image of some documents' ids; ``starts`` has one more entry."""
    rest = np.ascontiguousarray(ids, np.uint32)
    levels = []
    while True:
        on = rest >> CHUNK != 0
        chunks = (rest & ((1 << CHUNK) - 1)).astype(np.uint8)
        padded = np.zeros(-(-len(on) // STEP) * STEP, bool)
        padded[:len(on)] = on
        each = padded.reshape(-1, STEP).sum(1)
        ranks = (np.cumsum(each) - each).astype("<u4")
        levels.append(struct.pack("<Q", len(on)) + chunks.tobytes() + np.packbits(padded, bitorder="little").tobytes() + ranks.tobytes())
        if not on.any():
            break
        rest = rest[on] >> CHUNK
    head = MAGIC + struct.pack("<IQB", len(starts) - 1, len(ids), len(levels))
    return head + np.asarray(starts, "<u8").tobytes() + b"".join(levels)


class Image:
    """Reads a file image in place."""

    def __init__(self, data):
        if bytes(data[:4]) != MAGIC:
            raise ValueError("not a token file")
        self.documents, self.n_ids, levels = struct.unpack_from("<IQB", data, 4)
        at = 17
        self.starts = np.frombuffer(data, "<u8", self.documents + 1, at).astype(np.int64)
        at += 8 * (self.documents + 1)
        self.levels = []
        for _ in range(levels):
            (n,) = struct.unpack_from("<Q", data, at)
            blocks = -(-n // STEP)
            chunks = np.frombuffer(data, np.uint8, n, at + 8)
            bitmap = np.frombuffer(data, np.uint8, blocks * STEP // 8, at + 8 + n)
            ranks = np.frombuffer(data, "<u4", blocks, at + 8 + n + len(bitmap))
            self.levels.append((chunks, bitmap, ranks))
            at += 8 + n + len(bitmap) + 4 * blocks

    def get(self, places) -> np.ndarray:
        """The ids at any places, without decoding others."""
        at = np.asarray(places, np.int64)
        out = np.zeros(len(at), np.uint32)
        who = np.arange(len(at))
        for level, (chunks, bitmap, ranks) in enumerate(self.levels):
            out[who] |= chunks[at].astype(np.uint32) << np.uint32(CHUNK * level)
            on = bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1
            who, at = who[on], at[on]
            if not len(at):
                break
            at = self._rank(bitmap, ranks, at)
        return out

    def _rank(self, bitmap, ranks, at) -> np.ndarray:
        """Set bits before each place: the directory's, then those of its block."""
        words = bitmap.view("<u8")
        word = at >> 6
        first = (at // STEP) * (STEP >> 6)
        count = np.bitwise_count(words[word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))).astype(np.int64)
        for k in range(STEP >> 6):                       # whole words between the block's start and the place
            inside = first + k < word
            if not inside.any():
                break
            count[inside] += np.bitwise_count(words[(first + k)[inside]])
        return ranks[at // STEP].astype(np.int64) + count

    def document(self, i: int) -> np.ndarray:
        return self.get(np.arange(self.starts[i], self.starts[i + 1]))

    def all(self) -> np.ndarray:
        """Every id, level by level from the last."""
        rest = np.zeros(0, np.uint32)
        for chunks, bitmap, _ in reversed(self.levels):
            out = chunks.astype(np.uint32)
            on = np.flatnonzero(np.unpackbits(bitmap, count=len(chunks), bitorder="little"))
            out[on] |= rest << np.uint32(CHUNK)
            rest = out
        return rest


def write_tokens(docs: DataFrame, vocabulary: str, folder: str | None = None) -> str:
    """Encode whole texts with the tokenizers library, an end id after each,
    and write them to ``folder`` (else a new one beside the checkpoints).

    Null texts are empty. Documents stand by doc_id, nulls last, then by a
    hash of the text. Other columns are ignored. Returns the folder.
    """
    spark = docs.sparkSession
    ship(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    folder = folder or f"{ensure_checkpoint_dir(spark).rstrip('/')}/token-files-{uuid.uuid4().hex}"
    placed = (keyed(docs.select("doc_id", "text")).select("_k", "doc_id", text_bytes().alias("_b"))
              .repartitionByRange(parallelism(spark), "_k").sortWithinPartitions("_k"))

    def run(batches):
        from kinrank.llm.tokens import encoder

        enc, part = encoder(vocabulary), TaskContext.get().partitionId()
        seq = before = 0
        for b in batches:
            buf, off = values(b.column("_b"))
            for i, j in groups(off):
                ids, count = enc.encode(buf[off[i]:off[j]], off[i:j + 1] - off[i])
                starts = np.concatenate([[0], np.cumsum(count + 1)])
                all_ids = np.full(starts[-1], END, np.uint32)
                keep = np.ones(starts[-1], bool)
                keep[starts[1:] - 1] = False
                all_ids[keep] = ids
                names = b.column("doc_id").slice(i, j - i).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([before], pa.int64()),
                     pa.array([starts[-1]], pa.int64()), pa.array([names], pa.list_(b.schema.field("doc_id").type)),
                     pa.array([encode(all_ids, starts)], pa.binary())],
                    names=["part", "seq", "before", "n_ids", "doc_ids", "image"])
                seq, before = seq + 1, before + int(starts[-1])

    schema = f"part int, seq int, before long, n_ids long, doc_ids array<{kind}>, image binary"
    arrow_sized(placed).drop("_k").mapInArrow(run, schema).write.parquet(folder)
    return folder


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, ids binary`` (little-endian u32) of every document in
    the files; ``start`` counts the ids of all documents before it."""
    ship(spark)
    files = spark.read.parquet(folder)
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()
    base = files.groupBy("part").agg(F.sum("n_ids").alias("n"))                     # a row per part
    base = base.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                image = Image(b.column("image")[i].as_buffer())
                ids, at = image.all().astype("<u4"), image.starts
                first = b.column("base")[i].as_py() + b.column("before")[i].as_py()
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_ids")[i].values, pa.array(at[:-1] + first),
                     pa.array([ids[s:e].tobytes() for s, e in zip(at[:-1].tolist(), at[1:].tolist())], pa.binary())],
                    names=["doc_id", "start", "ids"])

    return (files.join(F.broadcast(base), "part").select("base", "before", "doc_ids", "image")
            .mapInArrow(run, f"doc_id {kind}, start long, ids binary"))


def lookup(spark: SparkSession, folder: str, doc_id, places: list[int]) -> list[int]:
    """Single ids of one document, read through the rank directories."""
    row = (spark.read.parquet(folder).where(F.array_contains("doc_ids", doc_id)).select("doc_ids", "image").first())
    if row is None:
        raise KeyError(doc_id)
    image, i = Image(row["image"]), row["doc_ids"].index(doc_id)
    return image.get(image.starts[i] + np.asarray(places, np.int64)).tolist()


def op8(spark, sf_dir):
    from kinrank.llm.common import table
    from kinrank.llm.packing import vocabulary

    folder = write_tokens(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
    return read_tokens(spark, folder).select("doc_id", "start", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                                             F.crc32("ids").alias("ids_crc32"))


__all__ = ["Image", "encode", "lookup", "op8", "read_tokens", "write_tokens"]
