"""Pair sums added up where an entity is (J2, A3, M1-M3, W1), for sparse ratings.

The plain way (``pairs``) makes a row of every pair of raters of every key and
shuffles it to its pair. On sparse ratings two entities rarely share more than
one key, so the partial aggregate merges next to nothing and every pair is
shuffled as a row of sums, and once more for a ranking. Here the raters of a key
become short lists; a rating carries its key's lists to its entity's group, and
the sums are added up there in arrays. What crosses the network is an id and a
value a pair, and a ranking has all of an entity's pairs at hand.

Bounds. A list holds at most about ``LIST`` raters, so a key with very many is many
lists. There are as many groups as give each about ``PAIRS`` pairs. An entity
that may have more than ``HEAVY`` pairs of its own is left to the plain way, whose
hot-key splitting spreads it over tasks. ``fits`` says whether lists are the
cheaper way at all: on dense ratings, where pairs share several keys, the plain
aggregate or ``threshold``'s cells are.
"""

from __future__ import annotations

import sys
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinrank.constants import PEARSON_MIN_COMMON, PEARSON_MIN_STD
from kinrank.operators.skew import DEFAULT_HOT_THRESHOLD, output_partitions, split_join
from kinrank.schema import NEIGHBOUR, RATING, SIM
from kinrank.session import parallelism, release

# Functions of this module go to the workers by value, so that they need not import it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LIST = 4096                           # raters of a list, about
WHOLE = 2.0 ** 52                     # whole numbers below are kept as such
PAIRS = 2_000_000                     # pairs of a group, about
HEAVY = 2_000_000                     # pairs of an entity beyond which the plain way takes it


class Shape:
    """What decides the way: counts from two small aggregates."""

    def __init__(self, ratings: DataFrame, entity: str, through: str):
        m = F.col("m").cast("double")
        of = lambda c: ratings.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("m"))
        t = of(through).agg(F.sum(m * m).alias("pairs"), F.max("m").alias("most"), F.count(F.lit(1)).alias("n")).first()
        e = of(entity).agg(F.count(F.lit(1)).alias("n"), F.max("m").alias("most"), F.sum("m").alias("rows")).first()
        self.pairs, self.most_raters = t["pairs"] or 0.0, t["most"] or 0
        self.entities, self.most_keys, self.keys, self.rows = e["n"], e["most"] or 0, t["n"], e["rows"] or 0
        release(ratings.sparkSession)

    def fits(self) -> bool:
        """Whether two entities share less than one key on average."""
        return self.pairs < float(self.entities) * self.entities

    def heavy(self) -> int | None:
        """The number of ratings beyond which an entity may have too many pairs;
        None if none has."""
        if self.most_keys * self.most_raters <= HEAVY:
            return None
        return max(1, HEAVY // max(1, self.most_raters))


def _lists(base: DataFrame, most_raters: int, values: int) -> DataFrame:
    """``_t, _c, _v, _y0..``: the raters of a key and their values, in lists."""
    rows = base.withColumn("_c", F.lit(0))
    if most_raters > LIST:
        n = base.groupBy("_t").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > LIST)
        parts = F.coalesce(F.ceil(F.col("_n") / F.lit(LIST)), F.lit(1))
        rows = base.join(n, "_t", "left").withColumn("_c", F.pmod(F.xxhash64("_u"), parts).cast("int"))
    return rows.groupBy("_t", "_c").agg(F.collect_list("_u").alias("_v"), *[F.collect_list(f"_x{i}").alias(f"_y{i}") for i in range(values)])


def _packer(count: int):
    """Lists as bytes: ids in order as steps, then ``count`` values, byte by byte of
    all of them, so that the bytes that are zero throughout pack to nothing; at the
    end a byte for each value, 1 if a list's are whole numbers, kept as such (sign
    in the lowest bit)."""
    def run(batches):
        for b in batches:
            out = [z.transpose(0, 2, 1).tobytes() + whole for _, _, z, whole in _bits(b, count)]
            yield pa.RecordBatch.from_arrays([b.column("_t"), b.column("_c"), pa.array(out, pa.binary())], names=["_t", "_c", "_b"])

    return run


def _bits(b: pa.RecordBatch, count: int):
    """Of each list its ids and values in order, the bytes of its steps and
    values, and which values are whole numbers."""
    at, ids = b.column("_v").offsets.to_numpy(), b.column("_v").values.to_numpy()
    plain = [b.column(f"_y{i}").values.to_numpy() for i in range(count)]
    values, whole = [], []
    for y in plain:
        small = np.where(np.abs(y) < WHOLE, y, 0.0).astype(np.int64)
        fits = np.minimum.reduceat(np.append(small == y, True), at[:-1]) if len(y) else np.zeros(0, bool)
        values.append(np.where(np.repeat(fits, np.diff(at)), (small << 1) ^ (small >> 63), y.view(np.int64)))
        whole.append(fits.astype(np.uint8))
    whole = np.stack(whole, 1)
    for i, (s, e) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
        order = np.argsort(ids[s:e], kind="stable")
        v = ids[s:e][order]
        all_ = np.stack([z.view(np.uint8).reshape(-1, 8) for z in (np.diff(v, prepend=0), *[y[s:e][order] for y in values])])
        yield v, [y[s:e][order] for y in plain], all_, whole[i].tobytes()


def unpacked(lists: pa.ChunkedArray, count: int = 1):
    """``row, v, y..``: every id and its ``count`` values of packed lists, and its list's row."""
    data = lists.combine_chunks()
    data = pa.concat_arrays(data.chunks) if isinstance(data, pa.ChunkedArray) else data
    at = np.frombuffer(data.buffers()[1], np.int32)[data.offset:data.offset + len(data) + 1].astype(np.int64)
    buf = np.frombuffer(data.buffers()[2], np.uint8) if len(data) and at[-1] else np.zeros(0, np.uint8)
    each = 1 + count
    size = np.diff(at) // (8 * each)
    row, v, y = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [[np.zeros(0)] for _ in range(count)]
    for m in np.unique(size).tolist():
        which = np.flatnonzero(size == m)
        all_ = buf[at[which][:, None] + np.arange(8 * each * m)].reshape(len(which), each, 8, m).transpose(1, 0, 3, 2)
        all_ = np.ascontiguousarray(all_)
        v.append(np.cumsum(all_[0].view(np.int64)[:, :, 0], axis=1).ravel())
        for i in range(count):
            bits = all_[1 + i].view(np.int64)[:, :, 0]
            whole = buf[at[which] + 8 * each * m + i] == 1
            y[i].append(np.where(whole[:, None], ((bits >> 1) ^ -(bits & 1)).astype(float), bits.view(np.float64)).ravel())
        row.append(np.repeat(which, m))
    return np.concatenate(row), np.concatenate(v), *[np.concatenate(z) for z in y]


def packed_lists(rows: DataFrame, by: str, member: str, value: str | tuple[str, ...], most: int) -> DataFrame:
    """``_t, _c, _b``: the ``member`` and the value or values of every ``by``, in packed lists."""
    values = (value,) if isinstance(value, str) else value
    base = rows.select(F.col(member).cast("long").alias("_u"), F.col(by).cast("long").alias("_t"),
                       *[F.coalesce(F.col(x).cast("double"), F.lit(float("nan"))).alias(f"_x{i}") for i, x in enumerate(values)])
    return _lists(base.where(F.col("_u").isNotNull()), most, len(values)).mapInArrow(_packer(len(values)), "_t long, _c int, _b binary")


def _groups(spark, elements: float) -> int:
    return int(max(parallelism(spark), -(-elements // PAIRS)))


def _grouped(rows: DataFrame, groups: int) -> DataFrame:
    return rows.withColumn("_g", F.pmod(F.xxhash64("_u"), F.lit(groups)).cast("int")).repartition(groups, "_g")


def with_lists(own: DataFrame, rows: DataFrame, most: int, elements: float, entity: str, member: str, through: str,
               value: str | tuple[str, ...]) -> DataFrame:
    """``_t, _u, .., _b``: every row of ``own`` with a packed list of the ``member``
    and ``value`` of the rows of its key, ``most`` of a key at most and about
    ``elements`` in all. Other columns of ``own`` stay."""
    n = output_partitions(rows.sparkSession, int(elements))
    lists = packed_lists(rows, through, member, value, most)
    left = own.withColumn("_t", F.col(through).cast("long")).withColumn("_u", F.col(entity).cast("long")).where(F.col("_u").isNotNull())
    left = left.drop(entity, through)
    if most > DEFAULT_HOT_THRESHOLD:
        j = split_join(left, lists, "_t", "_u", "_c", hot_threshold=DEFAULT_HOT_THRESHOLD)
    else:
        j = left.repartition(n, "_t").join(lists.repartition(n, "_t"), "_t")
    return j.drop("_c")


def gathered(own: DataFrame, rows: DataFrame, most: int, elements: float, entity: str, member: str, through: str,
             value: str) -> DataFrame:
    """``with_lists`` in groups ``_g`` by ``entity``."""
    return _grouped(with_lists(own, rows, most, elements, entity, member, through, value), _groups(rows.sparkSession, elements))


def _sums(table: pa.Table):
    """``u, v, n, x, y, first``: the pairs of a group in order, how many keys each
    shares, and the values at those keys, which begin at ``first``."""
    row, v, y = unpacked(table.column("_b"))
    u, x = table.column("_u").to_numpy()[row], table.column("_x").to_numpy()[row]
    other = u != v
    u, v, x, y = u[other], v[other], x[other], y[other]
    order = np.lexsort((v, u))
    u, v, x, y = u[order], v[order], x[order], y[order]
    new = np.ones(len(u), bool)
    new[1:] = (u[1:] != u[:-1]) | (v[1:] != v[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(u)))
    return u[first], v[first], count, x, y, first


def _ratio(top, ok, *norms):
    den = np.ones(len(top))
    for z in norms:
        den = den * np.sqrt(np.where(ok, z, 1.0))
    return np.where(ok, top / den, 0.0)


def similarities(table: pa.Table, measure: str):
    """``u, v, n_common, similarity`` of a group's pairs: the arithmetic of
    ``functions.columns``, in the same order."""
    return measured(*_sums(table), measure)


def measured(u, v, n, x, y, first, measure: str):
    add = lambda z: np.add.reduceat(np.nan_to_num(z, nan=0.0, posinf=np.inf, neginf=-np.inf), first) if len(first) else np.zeros(0)
    xy, xx, yy = add(x * y), add(x * x), add(y * y)
    if measure == "overlap":
        return u, v, n, _ratio(xy, (xx > 0) & (yy > 0), xx, yy)
    sx, sy = add(x), add(y)
    spread = lambda z: (np.fmax.reduceat(z, first) - np.fmin.reduceat(z, first)) if len(first) else np.zeros(0)
    vx, vy, cov = n * xx - sx * sx, n * yy - sy * sy, n * xy - sx * sy
    ok = (n >= PEARSON_MIN_COMMON) & (vx > 0) & (vy > 0) & (spread(x) > 0) & (spread(y) > 0)
    ok &= (np.sqrt(np.where(ok, vx, 0.0)) / n > PEARSON_MIN_STD) & (np.sqrt(np.where(ok, vy, 0.0)) / n > PEARSON_MIN_STD)
    return u, v, n, np.clip(_ratio(cov, ok, vx, vy), -1.0, 1.0)


def _later(count: int):
    """Of each list a row for every member but the last: its id, its values and the
    list of the members after it, whose steps begin at its id."""
    def run(batches):
        for b in batches:
            ids, own, out = [], [], []
            for v, values, z, whole in _bits(b, count):
                ids.append(v[:-1])
                own.append([y[:-1] for y in values])
                out += [z[:, i:].transpose(0, 2, 1).tobytes() + whole for i in range(1, len(v))]
            cat = lambda z, kind: pa.array(np.concatenate(z) if z else np.zeros(0), kind)
            yield pa.RecordBatch.from_arrays([cat(ids, pa.int64()), *[cat([y[i] for y in own], pa.float64()) for i in range(count)], pa.array(out, pa.binary())],
                                             names=["_u", *[f"_x{i}" for i in range(count)], "_b"])

    return run


def _unordered(table: pa.Table, measure: str, count: int, steps: bool):
    row, v, *y = unpacked(table.column("_b"), count)
    u = table.column("_u").to_numpy()[row]
    x = [table.column(f"_x{i}").to_numpy()[row] for i in range(count)]
    if steps:
        v = v + u
    else:
        later = v > u
        u, v, x, y = u[later], v[later], [z[later] for z in x], [z[later] for z in y]
    order = np.lexsort((v, u))
    u, v, x, y = u[order], v[order], [z[order] for z in x], [z[order] for z in y]
    new = np.ones(len(u), bool)
    new[1:] = (u[1:] != u[:-1]) | (v[1:] != v[:-1])
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(u)))
    if measure != "cosine":
        return measured(u[first], v[first], n, x[0], y[0], first, measure)
    xy = np.add.reduceat(np.nan_to_num(x[0] * y[0], posinf=np.inf, neginf=-np.inf), first) if len(first) else np.zeros(0)
    a, b = x[1][first], y[1][first]
    return u[first], v[first], n, _ratio(xy, (a > 0) & (b > 0), a, b)


def unordered(rows: DataFrame, shape: Shape, measure: str, entity: str, through: str, values: tuple[str, ...]) -> DataFrame:
    """``entity, neighbour_id, n_common, similarity`` of every pair that shares a key,
    once, ``entity < neighbour_id``: a rating goes to its entity's group with the
    raters of its key whose ids are larger, and no row is made of a pair before
    its similarity is known."""
    spark, count, steps = rows.sparkSession, len(values), shape.most_raters <= LIST
    elements = shape.pairs / 2 if steps else shape.pairs
    if steps:
        base = rows.select(F.col(entity).cast("long").alias("_u"), F.col(through).cast("long").alias("_t"),
                           *[F.coalesce(F.col(x).cast("double"), F.lit(float("nan"))).alias(f"_x{i}") for i, x in enumerate(values)])
        lists = _lists(base.where(F.col("_u").isNotNull() & F.col("_t").isNotNull()), shape.most_raters, count)
        lists = lists.repartition(output_partitions(spark, int(elements)), "_t")
        own = lists.mapInArrow(_later(count), "_u long, " + ", ".join(f"_x{i} double" for i in range(count)) + ", _b binary")
    else:
        own = rows.select(entity, through, *[F.coalesce(F.col(x).cast("double"), F.lit(float("nan"))).alias(f"_x{i}") for i, x in enumerate(values)])
        own = with_lists(own, rows, shape.most_raters, elements, entity, entity, through, values).drop("_t")

    def run(table):
        u, v, n, sim = _unordered(table, measure, count, steps)
        return pa.table({entity: pa.array(u), NEIGHBOUR: pa.array(v), "n_common": pa.array(n.astype(np.int64)), SIM: pa.array(sim)})

    return (_grouped(own, _groups(spark, elements)).groupBy("_g")
            .applyInArrow(run, f"{entity} long, {NEIGHBOUR} long, n_common long, {SIM} double"))


def place_of(u: np.ndarray) -> np.ndarray:
    """Places from 1 within runs of equal ``u``."""
    new = np.ones(len(u), bool)
    new[1:] = u[1:] != u[:-1]
    first = np.flatnonzero(new)
    return np.arange(len(u)) - np.repeat(first, np.diff(np.append(first, len(u)))) + 1


def nearest_of(u, v, sim, n: int, threshold: float | None, entities: int | None):
    """Rows of ``neighbours.top_neighbours`` (``entities`` None) or
    ``top_neighbours_all`` of a group's pairs: indices and ranks."""
    if entities is None:
        at = np.flatnonzero(sim > threshold) if threshold is not None else np.arange(len(u))
        at = at[np.lexsort((v[at], -sim[at], u[at]))]
        rank = place_of(u[at])
        return at[rank <= n], rank[rank <= n]
    at = np.flatnonzero(sim > 0)
    at = at[np.lexsort((v[at], -sim[at], u[at]))]
    rank = place_of(u[at])
    at, rank = at[rank <= n], rank[rank <= n]
    neg = np.flatnonzero(sim < 0)
    neg = neg[np.lexsort((v[neg], -sim[neg], u[neg]))]
    j = place_of(u[neg])
    _, inverse, q = np.unique(u[neg], return_inverse=True, return_counts=True)
    late = entities - q[inverse] - 1 + j if len(neg) else j
    keep = (q[inverse] >= entities - n) & (j <= n) & (late <= n) if len(neg) else np.zeros(0, bool)
    return np.concatenate([at, neg[keep]]), np.concatenate([rank, late[keep]])


def _pairs(own: DataFrame, rows: DataFrame, shape: Shape, entity: str, through: str, value: str) -> DataFrame:
    own = own.select(entity, through, F.coalesce(F.col(value).cast("double"), F.lit(float("nan"))).alias("_x"))
    return gathered(own, rows, shape.most_raters, shape.pairs, entity, entity, through, value)


def nearest(own: DataFrame, rows: DataFrame, shape: Shape, measure: str, n: int, threshold: float | None,
            entities: int | None, entity: str, through: str, value: str) -> DataFrame:
    """``entity, neighbour_id, n_common, similarity, rank`` of the entities of ``own``."""
    def run(table):
        u, v, c, sim = similarities(table, measure)
        at, rank = nearest_of(u, v, sim, n, threshold, entities)
        return pa.table({entity: pa.array(u[at]), NEIGHBOUR: pa.array(v[at]), "n_common": pa.array(c[at].astype(np.int64)),
                         SIM: pa.array(sim[at]), "rank": pa.array(rank.astype(np.int32))})

    return (_pairs(own, rows, shape, entity, through, value).groupBy("_g")
            .applyInArrow(run, f"{entity} long, {NEIGHBOUR} long, n_common long, {SIM} double, rank int"))


def _cells_of(table: pa.Table, most: int):
    """Of each target cell of a group the sums over its ``most`` nearest raters by
    cosine, equal ones by id: ``u, t, num, den``."""
    lists, cells = (table.filter(pc.equal(table.column("_cell"), r)) for r in (False, True))
    row, rater, dev, n, norm = unpacked(cells.column("_b"), 3)
    u, t = cells.column("_u").to_numpy()[row], cells.column("_t").to_numpy()[row]
    other = u != rater
    u, t, rater, dev, n, norm = (z[other] for z in (u, t, rater, dev, n, norm))
    who, raters = np.unique(u), np.unique(rater)
    pair = np.searchsorted(who, u) * len(raters) + np.searchsorted(raters, rater)
    pairs, at = np.unique(pair, return_inverse=True)
    row, v, y = unpacked(lists.column("_b"))
    a, x = lists.column("_u").to_numpy()[row], lists.column("_x").to_numpy()[row]
    if not len(pairs):
        return u, t, np.zeros(0), np.zeros(0)
    i, j = np.searchsorted(who, a), np.searchsorted(raters, v)
    met = (i < len(who)) & (j < len(raters))
    i, j, a, v, x, y = (z[met] for z in (i, j, a, v, x, y))
    met = (who[i] == a) & (raters[j] == v)
    key = i[met] * len(raters) + j[met]
    place = np.minimum(np.searchsorted(pairs, key), len(pairs) - 1)
    met_pair = pairs[place] == key
    xy = np.bincount(place[met_pair], (x[met] * y[met])[met_pair], len(pairs))[at]
    _, first = np.unique(lists.column("_u").to_numpy(), return_index=True)
    ids, norms = lists.column("_u").to_numpy()[first], lists.column("_nx").to_numpy()[first]
    mine = np.minimum(np.searchsorted(ids, u), max(0, len(ids) - 1))
    own = np.where(ids[mine] == u, norms[mine], 0.0) if len(ids) else np.zeros(len(u))
    sim = _ratio(xy, (own > 0) & (norm > 0), own, norm)
    order = np.lexsort((rater, -sim, t, u))
    u, t, sim, c = u[order], t[order], sim[order], (dev / n)[order]
    new = np.ones(len(u), bool)
    new[1:] = (u[1:] != u[:-1]) | (t[1:] != t[:-1])
    cell = np.cumsum(new)
    keep = place_of(cell) <= most
    u, t, sim, c, cell = (z[keep] for z in (u, t, sim, c, cell))
    first = np.searchsorted(cell, np.arange(1, cell[-1] + 1))
    return u[first], t[first], np.add.reduceat(sim * c, first), np.add.reduceat(np.abs(sim), first)


def weighed_raters(cells: DataFrame, own: DataFrame, rows: DataFrame, shape: Shape, most: int, entity: str, through: str) -> DataFrame:
    """``entity, through, _num, _den``: the sums of ``nbcf`` over each cell's ``most``
    nearest raters by cosine. An entity's similarities are added up in its group
    and looked up by its cells there, so neither a pair nor a rater of a cell is
    a row. ``rows``: ``centered(.., with_norm=True)``; ``own``: those of the cells'
    entities."""
    m = cells.groupBy(through).agg(F.count(F.lit(1)).alias("a")).join(rows.groupBy(through).agg(F.count(F.lit(1)).alias("b")), through)
    elements = shape.pairs + float(m.agg(F.sum(F.col("a").cast("double") * F.col("b"))).first()[0] or 0.0)
    lists = with_lists(own.select(entity, through, F.col("dev").cast("double").alias("_x"), F.col("norm2").cast("double").alias("_nx")),
                       rows, shape.most_raters, elements, entity, entity, through, "dev")
    asked = with_lists(cells.select(entity, through), rows, shape.most_raters, elements, entity, entity, through, ("dev", "n", "norm2"))
    none = F.lit(None).cast("double")
    both = (lists.select("_u", "_t", "_x", "_nx", "_b", F.lit(False).alias("_cell"))
            .unionByName(asked.select("_u", "_t", none.alias("_x"), none.alias("_nx"), "_b", F.lit(True).alias("_cell"))))

    def run(table):
        u, t, num, den = _cells_of(table, most)
        return pa.table({entity: pa.array(u), through: pa.array(t), "_num": pa.array(num), "_den": pa.array(den)})

    return (_grouped(both, _groups(rows.sparkSession, elements)).groupBy("_g")
            .applyInArrow(run, f"{entity} long, {through} long, _num double, _den double"))


def rounded(x: np.ndarray) -> np.ndarray:
    """``functions.columns.round6`` in arrays: halves, as they are written, away from zero."""
    size = np.abs(x) * 1e6
    low = np.floor(size)
    out = (low + (size - low >= 0.5)) / 1e6
    for i in np.flatnonzero(np.abs(size - low - 0.5) < 1e-6).tolist():
        out[i] = float(Decimal(repr(float(abs(x[i])))).quantize(Decimal("0.000001"), ROUND_HALF_UP))
    return np.copysign(out, x)


def met_cells(table: pa.Table):
    """``row, cell, value, who, keys, lists``: what the neighbours of a group's entities
    rated, without the cells left out; ``cell`` is the place in ``who`` times the
    number of ``keys`` and the place in ``keys``."""
    lists, out = (table.filter(pc.equal(table.column("_out"), r)) for r in (False, True))
    row, t, c = unpacked(lists.column("_b"))
    who, i = np.unique(lists.column("_u").to_numpy()[row], return_inverse=True)
    keys, j = np.unique(t, return_inverse=True)
    cell = i * len(keys) + j
    r, t, _ = unpacked(out.column("_b"))
    u = out.column("_u").to_numpy()[r]
    known = np.isin(u, who) & np.isin(t, keys)
    gone = np.searchsorted(who, u[known]) * len(keys) + np.searchsorted(keys, t[known])
    keep = ~np.isin(cell, gone)
    return row[keep], cell[keep], c[keep], who, keys, lists


def of_each(lists: pa.Table, column: str) -> np.ndarray:
    """A column's value for each entity of a group, in order."""
    _, first = np.unique(lists.column("_u").to_numpy(), return_index=True)
    return lists.column(column).to_numpy(zero_copy_only=False)[first].astype(float)


def _predicted(table: pa.Table):
    """``entity's place, key, prediction`` of a group's cells, and ``who`` the places are of."""
    row, cell, c, who, keys, lists = met_cells(table)
    w = lists.column("_w").to_numpy()[row]
    cells, at = np.unique(cell, return_inverse=True)
    known = ~np.isnan(c)
    add = lambda z: np.bincount(at, z, len(cells)).astype(float)
    c = c - lists.column("_mv").to_numpy(zero_copy_only=False).astype(float)[row]
    num, den = add(np.where(known, w * c, 0.0)), add(np.abs(w))
    num[add(known) == 0] = np.nan
    keep = den > 0
    i, j = np.divmod(cells[keep], max(1, len(keys)))
    return i, keys[j], rounded(of_each(lists, "_m")[i] + num[keep] / den[keep]), who


def _recommended(table: pa.Table, n: int):
    i, t, pred, who = _predicted(table)
    order = np.lexsort((t, -pred, i))
    rank = place_of(i[order])
    order, rank = order[rank <= n], rank[rank <= n]
    return who[i[order]], t[order], pred[order], rank


def neighbours_lists(nb: DataFrame, rows: DataFrame, left_out: DataFrame | None, most: int, elements: float, entity: str, through: str,
                     value: str, known: DataFrame | None = None) -> DataFrame:
    """``_u, _w, _b, _out, ..`` in groups: each row of ``nb`` (``entity, neighbour_id, _w``
    and what else it has) with the neighbour's ``through`` and ``value``, and the
    ``through`` of ``left_out`` of its entities, in packed lists; where ``_out`` is
    null, the ``through`` and ``value`` of ``known``."""
    more = [c for c in nb.columns if c not in (entity, NEIGHBOUR)]
    has = with_lists(nb, rows.withColumnRenamed(entity, NEIGHBOUR), most, elements, entity, through, NEIGHBOUR, value)
    has = has.select("_u", "_t", *more, "_b", F.lit(False).alias("_out"))
    kinds = dict(has.dtypes)
    for own, name, out in ((left_out, "_one", F.lit(True)), (known, value, F.lit(None).cast("boolean"))):
        if own is None:
            continue
        own = own.withColumn("_one", F.lit(1.0)).select(entity, through, name).where(F.col(entity).isNotNull())
        own = packed_lists(own.join(nb.select(entity).distinct(), entity, "left_semi"), entity, through, name, LIST + 1)
        has = has.unionByName(own.select(F.col("_t").alias("_u"), F.lit(None).cast("long").alias("_t"),
                                         *[F.lit(None).cast(kinds[c]).alias(c) for c in more], "_b", out.alias("_out")))
    return _grouped(has, _groups(rows.sparkSession, elements)).groupBy("_g")


def recommended(nb: DataFrame, rows: DataFrame, left_out: DataFrame | None, n: int, most: int, elements: float, entity: str, through: str,
                score: str) -> DataFrame:
    """``entity, through, score, rank``: the ``n`` best predictions of each entity from
    its neighbours (``entity, neighbour_id, _w, _m, _mv``: weight, the entity's mean,
    the neighbour's) and their ratings, without ``left_out``. Sums and ranks are made in
    the entity's group, so no row is made of a prediction that isn't kept."""
    def run(table):
        u, t, pred, rank = _recommended(table, n)
        return pa.table({entity: pa.array(u), through: pa.array(t), score: pa.array(pred, from_pandas=True), "rank": pa.array(rank.astype(np.int32))})

    return (neighbours_lists(nb, rows, left_out, most, elements, entity, through, RATING)
            .applyInArrow(run, f"{entity} long, {through} long, {score} double, rank int"))


def predicted(nb: DataFrame, rows: DataFrame, most: int, elements: float, entity: str, through: str, score: str) -> DataFrame:
    """``entity, through, score``: all predictions of each entity (``nb``: as in
    ``recommended``), added up in its group, so that no rating of a neighbour is a row."""
    def run(table):
        i, t, pred, who = _predicted(table)
        return pa.table({entity: pa.array(who[i]), through: pa.array(t), score: pa.array(pred, from_pandas=True)})

    return (neighbours_lists(nb, rows, None, most, elements, entity, through, RATING)
            .applyInArrow(run, f"{entity} long, {through} long, {score} double"))


def _swept(table: pa.Table, n_min: int, n_max: int, top: int | None):
    """Of a group and every n from ``n_min`` to ``n_max``: how many of the best
    predictions from the n nearest neighbours are known, how many of those have an
    error, and the sum of its squares."""
    row, cell, c, who, keys, lists = met_cells(table)
    rank = lists.column("_r").to_numpy(zero_copy_only=False).astype(np.int64)[row]
    w = lists.column("_w").to_numpy()[row]
    c = c - lists.column("_mv").to_numpy(zero_copy_only=False).astype(float)[row]
    order = np.lexsort((rank, cell))
    cell, rank, w, c = cell[order], rank[order], w[order], c[order]
    given = ~np.isnan(c)
    num, den, some = np.where(given, w * c, 0.0), np.abs(w), given.astype(np.int64)
    place = place_of(cell)
    for p in range(2, int(place.max(initial=1)) + 1):         # sums in the order of the ranks
        at = np.flatnonzero(place == p)
        for z in (num, den, some):
            z[at] += z[at - 1]
    num[some == 0] = np.nan
    follows = np.append(cell[1:] == cell[:-1], False) if len(cell) else np.zeros(0, bool)
    a, b = np.maximum(rank, n_min), np.minimum(np.where(follows, np.append(rank[1:], 0) - 1, n_max), n_max)
    keep = (a <= b) & (den > 0)
    cell, a, b = cell[keep], a[keep], b[keep]
    i, j = np.divmod(cell, max(1, len(keys)))
    pred = rounded(of_each(lists, "_m")[i] + num[keep] / den[keep])
    order = np.lexsort((j, -pred, i))
    cell, a, b, i, pred = cell[order], a[order], b[order], i[order], pred[order]
    told = table.filter(pc.is_null(table.column("_out")))
    r, t, truth = unpacked(told.column("_b"))
    u = told.column("_u").to_numpy()[r]
    asked = np.isin(u, who)
    u, t, truth = np.searchsorted(who, u[asked]), t[asked], truth[asked]
    want = np.bincount(u, minlength=len(who)) if top is None else np.full(len(who), top)
    met = np.isin(t, keys)
    u, t, truth = u[met], t[met], truth[met]
    by_cell = np.argsort(cell, kind="stable")
    goal = u * len(keys) + np.searchsorted(keys, t)
    begin, end = (np.searchsorted(cell[by_cell], goal, side) for side in ("left", "right"))
    size = end - begin
    seg = by_cell[np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())]
    error = pred[seg] - np.repeat(truth, size)
    first = np.searchsorted(i, i)
    for n in range(n_min, n_max + 1):
        inside = (a <= n) & (n <= b)
        upto = np.cumsum(inside)
        best = inside & (upto - (upto[first] - inside[first]) <= want[i])
        e = error[best[seg]]
        yield n, len(e), int((~np.isnan(e)).sum()), float(np.nansum(e * e))


def swept(nb: DataFrame, rows: DataFrame, left_out: DataFrame | None, truth: DataFrame, n_min: int, n_max: int, top: int | None, most: int,
          elements: float, entity: str, through: str) -> DataFrame:
    """``n, hits, _known, _square`` of each group for the sweep over the neighbours'
    ranks (``nb``: as in ``recommended``, and ``_r``). Running sums, rankings and
    hits are made in the entity's group, so no row is made of a prediction."""
    def run(table):
        out = list(_swept(table, n_min, n_max, top))
        return pa.table({name: pa.array([x[at] for x in out], kind) for at, (name, kind) in enumerate(
            (("n", pa.int32()), ("hits", pa.int64()), ("_known", pa.int64()), ("_square", pa.float64())))})

    return (neighbours_lists(nb, rows, left_out, most, elements, entity, through, RATING, truth)
            .applyInArrow(run, "n int, hits long, _known long, _square double"))
