"""Similar pairs on dense ratings, by products of matrices.

On a small catalogue that everyone has rated much of, nearly all pairs of entities
share keys, so an exact answer looks at every pair: the work is quadratic, the
memory and what is shuffled need not be. An entity's ratings are one packed row.
Entities are dealt into groups of about ``GROUP``; a cell holds a group and ``SPAN``
groups that it is compared with, a few rows of them at a time. Each step is a
product of two bounded matrices in single precision, which says for sure of most
pairs that they stay under the bar (the threshold, or the n-th best so far); the
rest are added up again in double precision, so the rows are exact.

Rounding: a sum of at most ``T`` products differs by at most ``T * 2^-24`` of the
product of the norms over the same keys, so ``_slack`` is a bound, not a guess.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinrank.operators.centering import centered, entity_stats
from kinrank.operators.gather import Shape, packed_lists, unpacked
from kinrank.schema import NEIGHBOUR, SIM
from kinrank.session import parallelism

# Functions of this module go to the workers by value, so that they need not import it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MEASURES = ("overlap", "cosine")
KEYS = 4096                           # keys that a row of a matrix may have
GROUP, SPAN = 8192, 8                 # entities of a group, about; groups that one is compared with in a cell
LEAST = 512                           # entities of a group where there are few
STEP = 1024                           # entities compared with at a time
AT_ONCE = 100_000                     # pairs added up in double precision at a time


def fits(shape: Shape, measure: str) -> bool:
    return measure in MEASURES and 0 < shape.keys <= KEYS and not shape.fits()


def _slack(keys: int) -> float:
    return 8 * (keys + 4) * 2.0 ** -24


class _Side:
    """The matrices of one side of a cell: values, and which keys are rated."""

    def __init__(self, ids, groups, row, key, y, keys, measure):
        self.ids, self.groups = ids, groups
        self.x, self.m = np.zeros((len(ids), keys)), np.zeros((len(ids), keys), np.float32)
        self.x[row, key] = np.nan_to_num(y)
        self.m[row, key] = 1
        self.norm = (self.x * self.x).sum(1)
        if measure == "cosine":
            root = np.sqrt(np.where(self.norm > 0, self.norm, 1.0))
            self.a = (self.x / root[:, None]).astype(np.float32)
        else:
            most = np.abs(self.x).max(1, initial=0.0)        # a scale for each row, which the ratio does not feel
            self.a = (self.x / np.where(most > 0, most, 1.0)[:, None]).astype(np.float32)
            self.aa = self.a * self.a


def _sides(table: pa.Table, measure: str):
    row, v, y = unpacked(table.column("_b"))
    names, key = np.unique(v, return_inverse=True)
    ids, groups, right = (table.column(c).to_numpy() for c in ("_t", "_g", "_right"))
    out = []
    for r in (0, 1):
        which = np.flatnonzero(right == r)
        which = which[np.argsort(groups[which], kind="stable")]
        at = np.full(len(ids), -1)
        at[which] = np.arange(len(which))
        mine = at[row] >= 0
        out.append(_Side(ids[which], groups[which], at[row[mine]], key[mine], y[mine], max(1, len(names)), measure))
    return (*out, names)


def _approximate(a: _Side, b: _Side, s: slice, measure: str) -> np.ndarray:
    xy = a.a @ b.a[s].T
    if measure == "cosine":
        return xy
    den = np.sqrt(a.aa @ b.m[s].T)
    den *= np.sqrt(a.m @ b.aa[s].T)
    den[den == 0] = np.inf
    xy /= den
    return xy


def _exact(a: _Side, b: _Side, i: np.ndarray, j: np.ndarray, measure: str):
    """``n_common, similarity`` of pairs, as ``functions.columns`` has them."""
    n, sim = np.zeros(len(i), np.int64), np.zeros(len(i))
    dot = lambda p, q: np.einsum("ij,ij->i", p, q)
    for s in range(0, len(i), AT_ONCE):
        p, q = i[s:s + AT_ONCE], j[s:s + AT_ONCE]
        x, y, mx, my = a.x[p], b.x[q], a.m[p].astype(float), b.m[q].astype(float)
        n[s:s + AT_ONCE] = np.rint(dot(mx, my)).astype(np.int64)
        xy = dot(x, y)
        xx, yy = (a.norm[p], b.norm[q]) if measure == "cosine" else (dot(x * x, my), dot(y * y, mx))
        ok = (xx > 0) & (yy > 0)
        sim[s:s + AT_ONCE] = np.where(ok, xy / (np.sqrt(np.where(ok, xx, 1.0)) * np.sqrt(np.where(ok, yy, 1.0))), 0.0)
    return n, sim


def _steps(n: int):
    at, step = 0, 64                    # short ones first: they raise the bars
    while at < n:
        yield slice(at, min(n, at + step))
        at, step = at + step, min(2 * step, STEP)


def _above(table: pa.Table, measure: str, threshold: float):
    a, b, names = _sides(table, measure)
    keys = len(names)
    out = []
    for s in _steps(len(b.ids)):
        near = _approximate(a, b, s, measure) > threshold - _slack(keys)
        i, j = np.nonzero(near)
        j = j + s.start
        once = (a.groups[i] < b.groups[j]) | ((a.groups[i] == b.groups[j]) & (a.ids[i] < b.ids[j]))
        i, j = i[once], j[once]
        n, sim = _exact(a, b, i, j, measure)
        keep = (sim > threshold) & (n > 0)
        u, v = a.ids[i[keep]], b.ids[j[keep]]
        out.append((np.minimum(u, v), np.maximum(u, v), n[keep], sim[keep]))
    return [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3 + [np.zeros(0)]


def _best(table: pa.Table, measure: str, threshold: float, most: int):
    a, b, names = _sides(table, measure)
    keys = len(names)
    bar = np.full(len(a.ids), threshold)
    i, j, n, sim = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    for s in _steps(len(b.ids)):
        p, q = np.nonzero(_approximate(a, b, s, measure) >= (bar - _slack(keys)).astype(np.float32)[:, None] - np.float32(1e-6))
        q = q + s.start
        other = a.ids[p] != b.ids[q]
        p, q = p[other], q[other]
        c, d = _exact(a, b, p, q, measure)
        keep = (d > threshold) & (d >= bar[p]) & (c > 0)
        i, j, n, sim = (np.concatenate(z) for z in ((i, p[keep]), (j, q[keep]), (n, c[keep]), (sim, d[keep])))
        order = np.lexsort((b.ids[j], -sim, i))
        i, j, n, sim = i[order], j[order], n[order], sim[order]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        full = rank == most - 1
        bar[i[full]] = sim[full]
        keep = rank < most
        i, j, n, sim = i[keep], j[keep], n[keep], sim[keep]
    return a.ids[i], b.ids[j], n, sim


def _raters(table: pa.Table, most: int):
    """Of each target cell (``_own`` lists an entity's) the ``most`` raters among
    the right side that are nearest by cosine, equal ones by id; a rater that
    shares nothing has similarity 0. ``entity, key, rater, similarity, centred``."""
    a, b, names = _sides(table, "cosine")
    left = table.filter(pc.equal(table.column("_right"), 0))
    row, key, _ = unpacked(left.column("_own"))
    known = np.isin(key, names)
    row, col = row[known], np.searchsorted(names, key[known])
    row = np.argsort(a.ids)[np.searchsorted(np.sort(a.ids), left.column("_t").to_numpy())][row]
    keys = max(1, len(names))
    by_key = [np.sort(row[col == t]) for t in range(keys)]
    cells = max(1, len(row))
    bar = np.full((len(a.ids), keys), -np.inf)
    root = lambda z: np.sqrt(np.where(z.norm > 0, z.norm, 1.0))
    ra, rb = root(a), root(b)
    cell, j, sim, new = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), []

    def best():
        c, q, w = (np.concatenate([old, *more]) for old, more in zip((cell, j, sim), zip(*new)))
        order = np.lexsort((b.ids[q], -w, c))
        c, q, w = c[order], q[order], w[order]
        rank = np.arange(len(c)) - np.searchsorted(c, c)
        full = rank == most - 1
        bar.ravel()[c[full]] = w[full]
        keep = rank < most
        return c[keep], q[keep], w[keep]

    for s in _steps(len(b.ids)):
        like = (a.x @ b.x[s].T) / (ra[:, None] * rb[s][None, :])
        like[a.ids[:, None] == b.ids[s][None, :]] = -np.inf             # the target itself is no rater
        for t in range(keys):
            raters = np.flatnonzero(b.m[s, t])
            if not len(by_key[t]) or not len(raters):
                continue
            part = like[np.ix_(by_key[t], raters)]
            p, q = np.nonzero((part >= bar[by_key[t], t][:, None]) & (part > -np.inf))
            new.append((by_key[t][p] * keys + t, s.start + raters[q], part[p, q]))
        if sum(len(z[0]) for z in new) > most * cells // 2 or s.stop == len(b.ids):
            if new:
                cell, j, sim = best()
                new = []
    i, t = np.divmod(cell, keys)
    rated = b.m.sum(1)
    return a.ids[i], names[t] if len(names) else t, b.ids[j], sim, b.x[j, t] / np.maximum(1, rated[j])


def nearest_raters(ratings: DataFrame, cells: DataFrame, shape: Shape, most: int, entity: str, through: str) -> DataFrame:
    """``entity, through, neighbour_id, similarity, centered``: at least the ``most``
    raters of each cell's ``through`` that are nearest to its entity by cosine."""
    rows = packed_lists(centered(ratings, entity, entity_stats(ratings, entity)), entity, through, "dev", shape.most_keys).drop("_c")
    own = cells.select(entity, through, F.lit(1.0).alias("_one")).where(F.col(through).isNotNull())
    own = own.join(ratings.select(through).distinct(), through, "left_semi")          # no list is longer than the catalogue
    own = packed_lists(own, entity, through, "_one", shape.keys).select("_t", F.col("_b").alias("_own"))
    some = own.join(rows, "_t", "left").select("_t", F.coalesce("_b", F.lit(b"")).alias("_b"), "_own")

    def run(cell: pd.DataFrame) -> pd.DataFrame:
        table = pa.table({c: pa.array(cell[c], pa.binary() if c in ("_b", "_own") else None) for c in ("_t", "_g", "_right", "_b", "_own")})
        u, t, v, sim, c = _raters(table, most)
        return pd.DataFrame({entity: u, through: t, NEIGHBOUR: v, SIM: sim, "centered": c})

    return (_cells(some, rows.withColumn("_own", F.lit(b"")), shape, False, "_own")
            .applyInPandas(run, f"{entity} long, {through} long, {NEIGHBOUR} long, {SIM} double, centered double"))


def _cells(own: DataFrame, rows: DataFrame, shape: Shape, once: bool, *more: str) -> DataFrame:
    """``_cell, _right, _g, _t, _b``: each group with every ``SPAN`` groups; with
    ``once`` only with those of no lower number."""
    spark = rows.sparkSession
    groups = max(-(-shape.entities // GROUP), min(parallelism(spark), -(-shape.entities // LEAST)))
    spans = -(-groups // SPAN)
    g = F.pmod(F.xxhash64("_t"), F.lit(groups)).cast("int")
    span = F.floor(F.col("_g") / F.lit(SPAN)).cast("int")
    first = span if once else F.lit(0)
    last = F.col("_g") if once else F.lit(groups - 1)
    left = own.withColumn("_g", g).withColumn("_s", F.explode(F.sequence(first, F.lit(spans - 1)))).select("_t", "_b", "_g", *more, (F.col("_g") * spans + F.col("_s")).alias("_cell"), F.lit(0).alias("_right"))
    right = rows.withColumn("_g", g).withColumn("_h", F.explode(F.sequence(F.lit(0), last))).select("_t", "_b", "_g", *more, (F.col("_h") * spans + span).alias("_cell"), F.lit(1).alias("_right"))
    return left.unionByName(right).repartition(groups * spans, "_cell").groupBy("_cell")


def similar(ratings: DataFrame, shape: Shape, measure: str, threshold: float, most: int | None, entity: str, through: str,
            own: DataFrame | None = None) -> DataFrame:
    """``entity, neighbour_id, n_common, similarity`` over ``threshold`` (0 at
    least): every unordered pair once, or with ``most`` for each entity (of
    ``own``) at least its ``most`` best, by id where equal."""
    if threshold < 0:
        raise ValueError("pairs that share nothing have similarity 0: the threshold must be 0 at least")
    rows = packed_lists(centered(ratings, entity, entity_stats(ratings, entity)), entity, through, "dev", shape.most_keys).drop("_c")
    some = rows if own is None else rows.join(own.select(F.col(entity).cast("long").alias("_t")).distinct(), "_t", "left_semi")

    def run(cell: pd.DataFrame) -> pd.DataFrame:
        table = pa.table({c: pa.array(cell[c]) for c in ("_t", "_g", "_right", "_b")})
        u, v, n, sim = _above(table, measure, threshold) if most is None else _best(table, measure, threshold, most)
        return pd.DataFrame({entity: u, NEIGHBOUR: v, "n_common": n, SIM: sim})

    return _cells(some, rows, shape, most is None).applyInPandas(run, f"{entity} long, {NEIGHBOUR} long, n_common long, {SIM} double")
