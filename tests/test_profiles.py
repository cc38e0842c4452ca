"""Chunked profiles, unrated gaps and the exact split against plain versions."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from kinrank.operators import evaluate, profiles


@pytest.fixture(scope="module")
def ratings(spark):
    r = random.Random(1)
    cells = {(0, i): float(i % 5 + 1) for i in range(90)} | {(r.randint(1, 30), r.randint(-9, 99)): float(r.randint(1, 5)) for _ in range(400)}
    rows = [(u, i, v) for (u, i), v in cells.items()] + [(77, 5, 2.0)]
    return spark.createDataFrame(rows, "user_id long, item_id long, rating double").repartition(4).cache()


def test_chunks_hold_every_rating_in_bounded_rows(ratings):
    out = profiles.profile_chunks(ratings, chunk=7).collect()
    assert max(len(r.ids) for r in out) <= 7 and all(r.ids == sorted(r.ids) for r in out)
    got = sorted((r.user_id, i, v) for r in out for i, v in zip(r.ids, r.ratings))
    assert got == sorted(map(tuple, ratings.collect()))
    assert all(r.n_ratings == len(r.ids) for r in out)


def test_dot_products_by_chunk(ratings):
    rows = {}
    for u, i, v in ratings.collect():
        rows.setdefault(u, {})[i] = v
    pairs = ratings.select("user_id").distinct().crossJoin(ratings.select(F.col("user_id").alias("neighbour_id")).distinct()).where("user_id < neighbour_id")
    got = {(r.user_id, r.neighbour_id): (r.n_common, r.dot) for r in profiles.profile_dots(profiles.profile_chunks(ratings, chunk=9), pairs).collect()}
    want = {(a, b): (len(set(x) & set(y)), sum(x[i] * y[i] for i in set(x) & set(y))) for a, x in rows.items() for b, y in rows.items() if a < b and set(x) & set(y)}
    assert got == want


@pytest.mark.parametrize("chunk", [1, 6, 4096])
def test_gaps_are_the_complement(ratings, chunk):
    rows = [tuple(r)[:2] for r in ratings.collect()]
    catalogue = sorted({i for _, i in rows})
    want = sorted((u, i) for u in {u for u, _ in rows} for i in set(catalogue) - {j for v, j in rows if v == u})
    gaps = profiles.unrated_gaps(ratings, chunk=chunk)
    cells = []
    for g in gaps.collect():
        run = catalogue[catalogue.index(g.first_item_id):catalogue.index(g.last_item_id) + 1]
        assert len(run) == g.n_items
        cells += [(g.user_id, i) for i in run]
    assert sorted(cells) == want
    if chunk == 6:
        assert sorted(map(tuple, profiles.expand_gaps(gaps.where("user_id < 5"), ratings).collect())) == [c for c in want if c[0] < 5]
        plan = gaps._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Generate" not in plan


@pytest.mark.parametrize("percent,seed", [(20, ""), (35, "b"), (0, ""), (100, "")])
def test_every_users_share_is_exact(ratings, percent, seed):
    train, test = evaluate.split_exact(ratings, percent, seed)
    rows = [tuple(r) for r in ratings.collect()]
    want = []
    for u in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == u), key=lambda r: (hashlib.md5(f"{seed}:{r[0]}:{r[1]}".encode()).hexdigest(), r[1]))
        want += own[:len(own) * percent // 100]
    assert sorted(map(tuple, test.collect())) == sorted(want)
    assert sorted([*map(tuple, train.collect()), *map(tuple, test.collect())]) == sorted(rows)


def test_another_seed_is_another_split_and_empty_tables_stay_empty(ratings):
    a, b = (set(map(tuple, evaluate.split_exact(ratings, 20, s)[1].collect())) for s in ("1", "2"))
    assert a != b and len(a) == len(b)
    none = ratings.where("false")
    assert evaluate.split_exact(none)[1].count() == profiles.profile_chunks(none).count() == profiles.unrated_gaps(none).count() == 0
