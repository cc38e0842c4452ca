"""Exact inner-product search against scoring every cell."""

import numpy as np
import pytest

from kinrank.operators import mips


def brute(x, w, rated, n):
    out = []
    for u, f in x.items():
        cells = sorted((-float(np.dot(f, g)), i) for i, g in w.items() if (u, i) not in rated)[:n]
        out += [(u, i, r + 1) for r, (_, i) in enumerate(cells)]
    return sorted(out)


@pytest.mark.parametrize("chunk", [1 << 20, 40 * 8 * 5])
def test_top_unrated_equals_scoring_every_cell(spark, chunk, monkeypatch):
    monkeypatch.setattr(mips, "FIRST_BLOCK", 8)
    r = np.random.default_rng(3)
    x = {u: r.integers(-4, 5, 3) / 2 for u in range(60)}                 # halves: sums are exact, ties are many
    w = {i: r.integers(-4, 5, 3) * (3.0 if i % 37 == 0 else 0.5) for i in range(150)}
    rated = {(u, i) for u in range(60) for i in range(150) if (u * 7 + i * 3) % 11 == 0 or u == 5 and i > 3}
    sp = lambda d, k: spark.createDataFrame([(a, [float(v) for v in f]) for a, f in d.items()], f"{k} long, features array<float>")
    out = mips.top_unrated(sp(x, "_u"), sp(w, "_i"), spark.createDataFrame(sorted(rated), "_u long, _i long"), 6, chunk)
    assert sorted((t._u, t._i, t.rank) for t in out.collect()) == brute(x, w, rated, 6)


def test_users_leave_and_no_cross_product(spark):
    x = spark.createDataFrame([(u, [1.0, 0.5]) for u in range(20)], "_u long, features array<float>")
    w = spark.createDataFrame([(i, [10.0 / (i + 1), 0.0]) for i in range(300)], "_i long, features array<float>")
    rated = spark.createDataFrame([(1, 0), (1, 1)], "_u long, _i long")
    out = mips.top_unrated(x, w, rated, 2, 8 * 4 * 10)
    assert {t._i for t in out.where("_u = 1").collect()} == {2, 3} and out.count() == 40
    one = mips.top_unrated(x, w, rated, 2)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert mips.top_unrated(x, w.where("false"), rated, 2).count() == 0
    assert mips.top_unrated(x.where("false"), w, rated, 2).count() == 0


def test_users_are_dealt_by_number_and_zero_factors_take_the_first_items(spark, monkeypatch):
    scored = []
    scorer = mips._scorer
    monkeypatch.setattr(mips, "_scorer", lambda sent, n: scored.append(len(sent.value[0])) or scorer(sent, n))
    monkeypatch.setattr(mips, "FIRST_CHUNK", 16)
    monkeypatch.setattr(mips, "USERS", 4)
    x = {u: [0.0, 0.0] if u % 10 == 0 else [1.0, u % 3 - 1.0] for u in range(60)}
    w = {i: [8.0 / (1 + (i * 7) % 400), 1.0 / (1 + i)] for i in range(400)}
    rated = {(u, i) for u in range(60) for i in range(400) if (u + i) % 9 == 0 or u == 10 and i < 90}
    sp = lambda d, k: spark.createDataFrame(list(d.items()), f"{k} long, features array<double>")
    out = mips.top_unrated(sp(x, "_u"), sp(w, "_i"), spark.createDataFrame(sorted(rated), "_u long, _i long"), 3)
    assert sorted((t._u, t._i, t.rank) for t in out.collect()) == brute(x, w, rated, 3)
    assert sum(scored) < 400                                             # nobody needs the whole catalogue
    one = mips.top_unrated(sp(x, "_u"), sp(w, "_i").where("_i < 16"), spark.createDataFrame([(1, 2)], "_u long, _i long"), 3)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan                                  # not as many tasks as their bytes fill
