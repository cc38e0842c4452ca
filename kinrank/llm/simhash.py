"""Operator 4, SimHash near-duplicates by a self-join of the fingerprints' binary trie.

Only distinct fingerprints enter the trie. Its upper part is a table of nodes:
a prefix is split two bits at a time until no node holds more than LEAF
fingerprints, so a crowded corner of the space becomes more nodes and not a
larger task. Node pairs are then walked together from the root, as joins of the
pair table with the children of either side; a pair is dropped as soon as its
prefixes differ in more bits than allowed. Each surviving pair of leaves is one
bounded group, and inside it the walk goes on to the last bit, all pairs of a
level at a time in numpy.

A group reports a spanning forest of its links (at most one row per
fingerprint in it), and the components come from alternating star contractions
over those rows. Nothing is collected.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinrank.llm.common import ROW_BATCH_BYTES, arrow_sized, materialize, ship, signed, text_bytes

SHINGLE = 3
BITS = 2
SEED = 42
LEAF = 8192
STEP = 2
HOP = 4                               # bits that node pairs walk down at a time


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Majority of the bits of all shingles' XXH64, repeats included; 0 without words."""
    norm = b" ".join(text.lower().split())           # bytes.lower: A-Z only
    if not norm:
        return 0
    gaps = np.flatnonzero(np.frombuffer(norm, np.uint8) == 32)
    first, last = [0, *(gaps + 1).tolist()], [*gaps.tolist(), len(norm)]
    n = max(1, len(first) - shingle + 1)
    if n == 1:
        return xxhash.xxh64_intdigest(norm, SEED)
    data, x = memoryview(norm), xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        j = min(n, i + (1 << 16))
        h = np.array([x(data[s:e], SEED) for s, e in zip(first[i:j], last[i + shingle - 1:j + shingle - 1])], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp``: the 64-bit fingerprint of each text (null: empty), as a long."""
    ship(docs.sparkSession)

    def run(batches):
        for b in batches:
            t = b.column("_b")
            fp = [fingerprint(t[i].as_py(), shingle) for i in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(signed(fp))], names=["doc_id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (arrow_sized(docs.select(F.col(id_col).alias("doc_id"), text_bytes().alias("_b")), size=ROW_BATCH_BYTES)
            .mapInArrow(run, f"doc_id {kind}, fp long"))


def _prefix(col, depth: int):
    """The first ``depth`` bits of a fingerprint, the rest zero. Never a literal:
    a join on one would become a nested loop."""
    return F.col(col).bitwiseAND(F.lit(-1 << (64 - depth) if depth else 0).cast("long"))


def leaves(points: DataFrame, leaf: int = LEAF) -> DataFrame:
    """``fp, node, depth``: the trie node above each fingerprint."""
    depth, rest, done = 0, points.select("fp"), None
    while True:
        at = rest.withColumn("node", _prefix("fp", depth)).withColumn("depth", F.lit(depth))
        counts = at.groupBy("node").agg(F.count(F.lit(1)).alias("n"))
        most = counts.agg(F.max("n")).first()[0] or 0
        if most <= leaf or depth >= 64:
            return at if done is None else done.unionByName(at)
        if most > 4 * leaf:                           # no node is small enough to matter yet
            smallest = counts.agg(F.min("n")).first()[0]
            if smallest > leaf:
                depth += STEP
                continue
        heavy = materialize(counts.withColumn("heavy", F.col("n") > leaf).select("node", "heavy"))
        at = at.join(heavy, "node")
        ready = at.where("not heavy").drop("heavy").select("fp", "node", "depth")
        done = ready if done is None else done.unionByName(ready)
        rest = materialize(at.where("heavy").select("fp"))
        depth += STEP


def node_pairs(nodes: DataFrame, bits: int = BITS) -> DataFrame:
    """``a, da, b, db``: pairs of leaves (a <= b) whose prefixes differ in at
    most ``bits`` bits, found by walking the trie from the root in pairs,
    ``HOP`` bits at a time, so that no step makes all pairs of many nodes."""
    own = [r["depth"] for r in nodes.select("depth").distinct().collect()]                   # 33 at most
    depths = sorted({*own, *range(HOP, max(own, default=0), HOP)})
    zero = F.lit(0).cast("long")
    root = nodes.select(_prefix("node", 0).alias("a"), F.least("depth", F.lit(0)).alias("da")).distinct()
    pairs = root.select("a", "da", F.col("a").alias("b"), F.col("da").alias("db"))
    last = 0
    for depth in depths:
        # children of every node so far; a node's parent is its prefix, a leaf above is its own
        up = nodes.select(
            F.when(F.col("depth") < last, F.col("node")).otherwise(_prefix("node", last)).alias("up"), F.least("depth", F.lit(last)).alias("dup"),
            F.when(F.col("depth") < depth, F.col("node")).otherwise(_prefix("node", depth)).alias("node"), F.least("depth", F.lit(depth)).alias("depth")).distinct()
        left = up.select(F.col("up").alias("a"), F.col("dup").alias("da"), F.col("node").alias("na"), F.col("depth").alias("nda"))
        right = up.select(F.col("up").alias("b"), F.col("dup").alias("db"), F.col("node").alias("nb"), F.col("depth").alias("ndb"))
        both = pairs.join(left, ["a", "da"]).join(right, ["b", "db"])
        common = F.least("nda", "ndb")
        mask = F.when(common == 0, zero).otherwise(F.call_function("shiftleft", F.lit(-1).cast("long"), F.lit(64) - common))
        differ = F.bit_count(F.col("na").bitwiseXOR(F.col("nb")).bitwiseAND(mask))
        pairs = materialize(both.where((differ <= bits) & (F.col("na") <= F.col("nb"))).select(
            F.col("na").alias("a"), F.col("nda").alias("da"), F.col("nb").alias("b"), F.col("ndb").alias("db")))
        last = depth
    return pairs


def walk(a: np.ndarray, b: np.ndarray, depth: int, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of two sorted uint64 arrays within ``bits`` bits. Each array
    is one trie node at ``depth`` or below; node pairs are split bit by bit."""
    found_a, found_b = [], []
    if not len(a) or not len(b):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    high = np.uint64(0) if depth == 0 else np.uint64(0xFFFFFFFFFFFFFFFF) << np.uint64(64 - depth)
    la, ha, lb, hb = np.array([0]), np.array([len(a)]), np.array([0]), np.array([len(b)])
    d = np.bitwise_count((a[:1] ^ b[:1]) & high).astype(np.int64)
    for level in range(depth, 65):
        stay = d <= bits
        la, ha, lb, hb, d = la[stay], ha[stay], lb[stay], hb[stay], d[stay]
        small = (ha - la) * (hb - lb) <= 8                       # few leaves: look at them
        na, nb = (ha - la)[small], (hb - lb)[small]
        which = np.repeat(np.flatnonzero(small), na * nb)
        if len(which):
            step = np.arange(len(which)) - np.repeat(np.cumsum(na * nb) - na * nb, na * nb)
            x, y = la[which] + step // (hb - lb)[which], lb[which] + step % (hb - lb)[which]
            near = np.bitwise_count(a[x] ^ b[y]) <= bits
            found_a.append(x[near])
            found_b.append(y[near])
        la, ha, lb, hb, d = la[~small], ha[~small], lb[~small], hb[~small], d[~small]
        if level == 64 or not len(la):
            break
        bit = np.uint64(63 - level)
        sa = np.concatenate([[0], np.cumsum((a >> bit) & np.uint64(1), dtype=np.int64)])
        sb = np.concatenate([[0], np.cumsum((b >> bit) & np.uint64(1), dtype=np.int64)])
        ma, mb = ha - (sa[ha] - sa[la]), hb - (sb[hb] - sb[lb])  # where the ones begin
        parts = [(la, ma, lb, mb, d), (ma, ha, mb, hb, d), (la, ma, mb, hb, d + 1), (ma, ha, lb, mb, d + 1)]
        la, ha, lb, hb, d = (np.concatenate([p[i] for p in parts]) for i in range(5))
        full = (la < ha) & (lb < hb)
        la, ha, lb, hb, d = la[full], ha[full], lb[full], hb[full], d[full]
    cat = lambda v: np.concatenate(v) if v else np.zeros(0, np.int64)
    return cat(found_a), cat(found_b)


def forest(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The smallest index that each of ``n`` points reaches over the links."""
    label = np.arange(n)
    while True:
        p, q = label[x], label[y]
        apart = p != q
        if not apart.any():
            return label
        np.minimum.at(label, np.maximum(p, q)[apart], np.minimum(p, q)[apart])
        while (label != label[label]).any():
            label = label[label]


def links(points: DataFrame, bits: int = BITS, leaf: int = LEAF) -> DataFrame:
    """``u, v``: links between distinct fingerprints that join all that lie
    within ``bits`` bits of each other, a spanning forest per pair of leaves."""
    at = materialize(leaves(points, leaf))
    pairs = (node_pairs(materialize(at.select("node", "depth").distinct()), bits)
             .withColumn("cell", F.xxhash64("a", "da", "b", "db")))
    side = lambda n, d, s: pairs.select(F.col(n).alias("node"), F.col(d).alias("depth"), "a", "b", "cell",
                                        F.least("da", "db").alias("common"), F.lit(s).alias("side"))
    ends = side("a", "da", 0).unionByName(side("b", "db", 1).where("a != b"))
    cells = at.join(ends, ["node", "depth"]).select("a", "b", "cell", "common", "side", "fp")

    def group(pdf):
        one, x_all = pdf["a"].iat[0] == pdf["b"].iat[0], pdf["fp"].to_numpy().view(np.uint64)
        left = np.sort(x_all[(pdf["side"] == 0).to_numpy()])
        right = left if one else np.sort(x_all[(pdf["side"] == 1).to_numpy()])
        x, y = walk(left, right, int(pdf["common"].iat[0]), bits)
        if one:
            x, y = x[x < y], y[x < y]
            every = left
        else:
            y, every = y + len(left), np.concatenate([left, right])
        label = forest(len(every), x, y)
        child = np.flatnonzero(label != np.arange(len(every)))
        return pd.DataFrame({"u": every[child].view(np.int64), "v": every[label[child]].view(np.int64)})

    return cells.groupBy("cell", "a", "b").applyInPandas(group, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: for every node of ``edges (u, v)`` the least node of its
    component, by alternating large-star and small-star contractions. The rows
    never outgrow the edges; a hub's rows are split by adaptive skew joins."""
    e = materialize(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).where("u != v")
                 .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        e = materialize(small)
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", shingle: int = SHINGLE, bits: int = BITS,
                    leaf: int = LEAF) -> DataFrame:
    """``doc_id, fp long, component_id``: one row per row of ``docs``.

    Documents are linked where their fingerprints differ in at most ``bits``
    bits; component_id is the smallest id reachable (null ids count only where
    a component has no other). Texts without words, null ones too, share
    fingerprint zero. Repeated rows fall into one component; other columns of
    ``docs`` are not looked at.
    """
    ship(docs.sparkSession)
    fps = materialize(fingerprints(docs, id_col, shingle))
    points = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("least")))
    root = components(links(points, bits, leaf))
    of = (points.join(root, points["fp"] == root["node"], "left")
          .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    least = of.groupBy("root").agg(F.min("least").alias("component_id"))
    return fps.join(of.join(least, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def op4(spark, sf_dir):
    from kinrank.llm.common import table

    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
