"""Similar pairs above a threshold, without a row for every co-rated pair (M6).

The plain way makes a row of every pair of raters of every item, adds them up by
pair, and drops most pairs under the threshold. On dense ratings that is very
many rows for few results. Here the entities are dealt into groups of about
``GROUP``; every two groups meet in a cell, which holds a bounded number of
ratings and adds up its pairs in arrays. Only pairs above the threshold leave
it. A rating is copied once per group, so this is the cheaper way while ratings
times groups stay below the pair rows; ``similar_above`` compares the two counts,
taken in one small aggregate, and goes the plain way otherwise. Both are exact.
A dense table over a small catalogue goes by products of matrices (``dense``).

A group may hold an entity with a third of all ratings. Where a cell would hold
more than ``CELL_ROWS`` of them, the items are dealt into parts too; such cells
give partial sums, which are added up by pair before the threshold.

No bound from norms is used for ``overlap``: its norms are over the common items
alone, so one common item in any remainder can still give a similarity of 1.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinrank.functions.columns import cosine_from_sums, overlap_from_sums
from kinrank.operators import dense, gather
from kinrank.operators.centering import centered, entity_stats
from kinrank.operators.similarity import similarity
from kinrank.schema import ITEM, NEIGHBOUR, SIM, USER

GROUP = 1024                          # entities of a group, about
CELL_ROWS = 2_000_000                 # ratings of a cell, about
PAIRS_AT_ONCE = 2_000_000             # pairs of raters added up at a time, one item at least
SLACK = 1e-9


def work(ratings: DataFrame, entity: str, through: str, group: int = GROUP) -> dict[str, int]:
    """What both ways cost: ``rows`` of ratings, ``groups``, pair rows of the
    plain way (``pairs``), and the item ``parts`` that cells need."""
    of = lambda c: ratings.groupBy(c).agg(F.count(F.lit(1)).alias("m"))
    e = of(entity).agg(F.count(F.lit(1)).alias("n"), F.sum("m").alias("rows"), F.max("m").alias("most")).first()
    m = F.col("m").cast("double")
    pairs = of(through).agg(F.sum(m * (m - 1) / 2).alias("p")).first()["p"] or 0
    rows, groups = e["rows"] or 0, max(1, -(-e["n"] // group))
    return {"rows": rows, "groups": groups, "pairs": int(pairs),
            "parts": max(1, math.ceil(2 * (rows / groups + (e["most"] or 0)) / CELL_ROWS))}


def similar_above(ratings: DataFrame, threshold: float, measure: str = "overlap", *, entity: str = USER, through: str = ITEM,
                  min_common: int = 1, group: int = GROUP, cells: bool | None = None, parts: int | None = None) -> DataFrame:
    """``entity, neighbour_id, n_common, similarity`` of every unordered pair
    with a similarity over ``threshold`` (0 at least): the rows of
    ``similarity(...)`` over it. ``cells`` and ``parts`` force a way, for tests.
    """
    if threshold < 0:
        raise ValueError("pairs that share nothing have similarity 0: the threshold must be 0 at least")
    shape = gather.Shape(ratings, entity, through)
    if cells is None and parts is None and dense.fits(shape, measure):
        out = dense.similar(ratings, shape, measure, float(threshold), None, entity, through)
        return out.where(F.col("n_common") >= F.lit(min_common))
    cost = work(ratings, entity, through, group)
    if cells is None:
        cells = measure in ("overlap", "cosine") and 2 * cost["rows"] * cost["groups"] < cost["pairs"]
    if not cells:
        return similarity(ratings, measure, entity=entity, through=through, min_common=min_common).where(F.col(SIM) > F.lit(float(threshold)))
    if measure not in ("overlap", "cosine"):
        raise ValueError(f"no cells for {measure!r}")
    sums = _cell_sums(ratings, float(threshold), measure, entity, through, cost["groups"], parts or cost["parts"])
    sim = overlap_from_sums("sum_xy", "sum_xx", "sum_yy") if measure == "overlap" else cosine_from_sums("sum_xy", "sum_xx", "sum_yy")
    return (sums.select(entity, NEIGHBOUR, "n_common", sim.cast("double").alias(SIM))
            .where((F.col(SIM) > F.lit(float(threshold))) & (F.col("n_common") >= F.lit(min_common))))


def _cell_sums(ratings, threshold, measure, entity, through, groups, parts) -> DataFrame:
    """Sums of the pairs that may be over the threshold (``sum_xx`` and
    ``sum_yy`` are the whole norms for ``cosine``)."""
    base = centered(ratings, entity, entity_stats(ratings, entity), with_norm=True)
    g = F.pmod(F.xxhash64(entity), F.lit(groups)).cast("long")
    base = base.select(F.col(entity).cast("long").alias("e"), F.xxhash64(through).alias("t"), F.col("dev").cast("double").alias("v"),
                       F.col("norm2").cast("double").alias("n"), g.alias("g"))
    base = base.withColumn("h", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    low, high = F.least("g", "h"), F.greatest("g", "h")
    base = base.withColumn("cell", (low * groups + high) * parts + F.pmod("t", F.lit(parts)))
    whole, inside, at_once, slack = measure == "cosine", parts == 1, PAIRS_AT_ONCE, SLACK

    def add_up(rows: pd.DataFrame) -> pd.DataFrame:
        cell = int(rows["cell"].iloc[0]) // parts
        a, b = divmod(cell, groups)
        left = rows[rows["g"] == a].sort_values("t", kind="stable")
        right = left if a == b else rows[rows["g"] == b].sort_values("t", kind="stable")
        ids_l, at_l = np.unique(left["e"].to_numpy(), return_inverse=True)
        ids_r, at_r = np.unique(right["e"].to_numpy(), return_inverse=True)
        size = len(ids_l) * len(ids_r)
        count = np.zeros(size, np.int64)
        xy, xx, yy = np.zeros(size), np.zeros(size), np.zeros(size)
        item, first = np.unique(left["t"].to_numpy(), return_index=True)
        many_l = np.diff(np.append(first, len(left)))
        t_r = right["t"].to_numpy()
        begin, end = np.searchsorted(t_r, item, "left"), np.searchsorted(t_r, item, "right")
        v_l, v_r = left["v"].to_numpy(), right["v"].to_numpy()
        made = np.cumsum(many_l * (end - begin))
        i = 0
        while i < len(item):
            j = max(i + 1, int(np.searchsorted(made, (made[i - 1] if i else 0) + at_once, "right")))
            own = np.arange(first[i], first[j] if j < len(item) else len(left))
            which = np.repeat(np.arange(i, j), many_l[i:j])
            times = (end - begin)[which]
            l_row = np.repeat(own, times)
            ends = np.cumsum(times)
            r_row = np.arange(len(l_row)) + np.repeat(begin[which] - (ends - times), times)
            flat = at_l[l_row] * len(ids_r) + at_r[r_row]
            x, y = v_l[l_row], v_r[r_row]
            count += np.bincount(flat, minlength=size)
            xy += np.bincount(flat, x * y, size)
            if not whole:
                xx += np.bincount(flat, x * x, size)
                yy += np.bincount(flat, y * y, size)
            i = j
        row, col = np.divmod(np.arange(size), max(1, len(ids_r)))
        if whole:
            norm = lambda rows_, at, n: np.bincount(at, rows_["n"], n) / np.maximum(1, np.bincount(at, minlength=n))
            xx, yy = norm(left, at_l, len(ids_l))[row], norm(right, at_r, len(ids_r))[col]
        keep = count > 0
        if a == b:
            keep &= ids_l[row] < ids_r[col]
        if inside:
            den = np.sqrt(xx) * np.sqrt(yy)
            keep &= xy > (threshold - slack) * den - slack
            keep &= den > 0
        row, col, count, xy, xx, yy = (z[keep] for z in (row, col, count, xy, xx, yy))
        e, f = ids_l[row], ids_r[col]
        swap = e > f
        return pd.DataFrame({"e": np.where(swap, f, e), "f": np.where(swap, e, f), "n_common": count, "sum_xy": xy,
                             "sum_xx": np.where(swap, yy, xx), "sum_yy": np.where(swap, xx, yy)})

    out = base.drop("h").groupBy("cell").applyInPandas(add_up, "e long, f long, n_common long, sum_xy double, sum_xx double, sum_yy double")
    if not inside:
        whole_norm = F.max if whole else F.sum
        out = out.groupBy("e", "f").agg(F.sum("n_common").alias("n_common"), F.sum("sum_xy").alias("sum_xy"),
                                        whole_norm("sum_xx").alias("sum_xx"), whole_norm("sum_yy").alias("sum_yy"))
    return out.withColumnRenamed("e", entity).withColumnRenamed("f", NEIGHBOUR)
