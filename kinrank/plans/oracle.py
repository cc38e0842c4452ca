"""Equivalent SQL for each registered query, for a second engine (DuckDB)
over the same warehouse tables. Written from the operator definitions, in
plain joins and window functions, independently of the Spark plans (for
instance the catalogue recommendation here scores every unrated cell of a
users x items product, which the Spark plan avoids).

Numeric conventions shared with the Spark side: similarities come from
integer-valued sums (exact on both engines); values summed in
engine-dependent order are rounded to 6 digits; ties break by id.
"""

from __future__ import annotations

from kinrank.constants import (ALS_REG, BIASED_MAX_ITEMS, CLIP_HIGH, CLIP_LOW, DEMO_THRESHOLD, FRACTIONS, K_RATERS,
                               KNN_EPSILON, N_NEIGHBOURS, N_RECOMMEND, PEARSON_MIN_COMMON,
                               PEARSON_MIN_STD, SAMPLE_ITEM_MULT, SAMPLE_USER_MULT, SPLIT_BUCKETS,
                               SPLIT_ITEM_MULT, SPLIT_TRAIN_BUCKETS, SPLIT_USER_MULT, SWEEP,
                               TEST_PERCENT, THRESHOLD, TOP)

D = "CAST({} AS DOUBLE)".format

R_ORDERS = """ratings AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id,
         CAST(MAX(CAST(1 + floor((l_quantity - 1) / 10) AS BIGINT)) AS DOUBLE) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY o_custkey, l_partkey)"""

R_EVENTS = """ratings AS (
  SELECT user_id, item_id, CAST(MAX(r) AS DOUBLE) AS rating FROM (
    SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
           LEAST(5, CAST(1 + floor(value / 10) AS BIGINT)) AS r
    FROM events) e
  WHERE item_id IS NOT NULL AND r IS NOT NULL AND user_id IS NOT NULL
  GROUP BY user_id, item_id)"""

R_BASKETS = """ratings AS (
  SELECT l_orderkey AS user_id, l_partkey AS item_id,
         CAST(MAX(CAST(1 + floor((l_quantity - 1) / 10) AS BIGINT)) AS DOUBLE) AS rating
  FROM lineitem GROUP BY l_orderkey, l_partkey)"""

_CELL = (f"((user_id % {SPLIT_BUCKETS}) * {SPLIT_USER_MULT} + (item_id % {SPLIT_BUCKETS}) * {SPLIT_ITEM_MULT})"
         f" % {SPLIT_BUCKETS}")
SPLIT = f"""train AS (SELECT * FROM ratings WHERE {_CELL} < {SPLIT_TRAIN_BUCKETS}),
test AS (SELECT * FROM ratings WHERE {_CELL} >= {SPLIT_TRAIN_BUCKETS})"""


def stats(src="train", name="ust", cname="cent", ent="user_id", oth="item_id"):
    """Per-entity stats and centred rows with the scaled deviation and norm."""
    return f"""{name} AS (
  SELECT {ent}, COUNT(*) AS n, SUM(rating) AS rating_sum, SUM(rating * rating) AS sq,
         AVG(rating) AS mean_rating
  FROM {src} GROUP BY {ent}),
{cname} AS (
  SELECT t.{ent}, t.{oth}, t.rating, s.mean_rating, t.rating - s.mean_rating AS centered,
         s.n * t.rating - s.rating_sum AS dev,
         s.n * (s.n * s.sq - s.rating_sum * s.rating_sum) AS norm2
  FROM {src} t JOIN {name} s ON s.{ent} = t.{ent})"""


def overlap(cent="cent", name="sims", other=None, ent="user_id", oth="item_id"):
    right = other or cent
    cmp = "<>" if other else "<"
    return f"""{name}_p AS (
  SELECT a.{ent}, b.{ent} AS neighbour_id, COUNT(*) AS n_common,
         SUM(a.dev * b.dev) AS sxy, SUM(a.dev * a.dev) AS sxx, SUM(b.dev * b.dev) AS syy
  FROM {cent} a JOIN {right} b ON a.{oth} = b.{oth} AND a.{ent} {cmp} b.{ent}
  GROUP BY a.{ent}, b.{ent}),
{name} AS (
  SELECT {ent}, neighbour_id, n_common,
         CASE WHEN sxx > 0 AND syy > 0 THEN sxy / (sqrt(sxx) * sqrt(syy)) ELSE {D(0)} END AS similarity
  FROM {name}_p)"""


def cosine(cent="cent", name="sims", ent="user_id", oth="item_id"):
    return f"""{name}_p AS (
  SELECT a.{ent}, b.{ent} AS neighbour_id, COUNT(*) AS n_common, SUM(a.dev * b.dev) AS sxy,
         MAX(a.norm2) AS nl, MAX(b.norm2) AS nr
  FROM {cent} a JOIN {cent} b ON a.{oth} = b.{oth} AND a.{ent} < b.{ent}
  GROUP BY a.{ent}, b.{ent}),
{name} AS (
  SELECT {ent}, neighbour_id, n_common,
         CASE WHEN nl > 0 AND nr > 0 THEN sxy / (sqrt(nl) * sqrt(nr)) ELSE {D(0)} END AS similarity
  FROM {name}_p)"""


def corated(src="valid", name="sims", other=None):
    right = other or src
    cmp = "<>" if other else "<"
    vx = "(n * sxx - sx * sx)"
    vy = "(n * syy - sy * sy)"
    return f"""{name}_p AS (
  SELECT a.user_id, b.user_id AS neighbour_id, COUNT(*) AS n, SUM(a.rating) AS sx, SUM(b.rating) AS sy,
         SUM(a.rating * b.rating) AS sxy, SUM(a.rating * a.rating) AS sxx, SUM(b.rating * b.rating) AS syy,
         MAX(a.rating) - MIN(a.rating) AS spx, MAX(b.rating) - MIN(b.rating) AS spy
  FROM {src} a JOIN {right} b ON a.item_id = b.item_id AND a.user_id {cmp} b.user_id
  GROUP BY a.user_id, b.user_id),
{name} AS (
  SELECT user_id, neighbour_id, n AS n_common,
         CASE WHEN n >= {PEARSON_MIN_COMMON} AND {vx} > 0 AND {vy} > 0
                   AND sqrt({vx}) / n > {PEARSON_MIN_STD!r} AND sqrt({vy}) / n > {PEARSON_MIN_STD!r}
                   AND spx > 0 AND spy > 0
              THEN greatest({D(-1)}, least({D(1)}, (n * sxy - sx * sy) / (sqrt({vx}) * sqrt({vy}))))
              ELSE {D(0)} END AS similarity
  FROM {name}_p)"""


VALID = """vs AS (SELECT user_id FROM train GROUP BY user_id
       HAVING stddev_samp(rating) IS NOT NULL AND stddev_samp(rating) <> 0),
valid AS (SELECT * FROM train WHERE user_id IN (SELECT user_id FROM vs))"""


def neighbours(sims="sims", name="nb", t=THRESHOLD, n=N_NEIGHBOURS, targets="test", directed=False):
    sym = (f"SELECT user_id, neighbour_id, similarity FROM {sims} WHERE similarity > {t}" if directed else
           f"""SELECT user_id, neighbour_id, similarity FROM {sims} WHERE similarity > {t}
  UNION ALL
  SELECT neighbour_id AS user_id, user_id AS neighbour_id, similarity FROM {sims} WHERE similarity > {t}""")
    tgt = f"WHERE user_id IN (SELECT user_id FROM {targets})" if targets else ""
    return f"""{name}_s AS ({sym}),
{name} AS (
  SELECT user_id, neighbour_id, similarity, CAST(rk AS INTEGER) AS "rank" FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY similarity DESC, neighbour_id ASC) AS rk
    FROM {name}_s {tgt}) x
  WHERE rk <= {n})"""


def predict(nb="nb", cent="cent", means="ust", name="pred", item_filter="", n_filter=""):
    return f"""{name}_a AS (
  SELECT nb.user_id, c.item_id, SUM(nb.similarity * c.centered) AS num, SUM(abs(nb.similarity)) AS den
  FROM {nb} nb JOIN {cent} c ON c.user_id = nb.neighbour_id {item_filter} {n_filter}
  GROUP BY nb.user_id, c.item_id),
{name} AS (
  SELECT a.user_id, a.item_id, round(m.mean_rating + a.num / a.den, 6) AS predicted_rating
  FROM {name}_a a JOIN {means} m ON m.user_id = a.user_id WHERE a.den > 0)"""


def top(src, n, ent="user_id", oth="item_id", score="predicted_rating", cols=None):
    cols = cols or f"{ent}, {oth}, {score}"
    return f"""SELECT {cols}, CAST(rk AS INTEGER) AS "rank" FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY {ent} ORDER BY {score} DESC, {oth} ASC) AS rk FROM {src}) x
WHERE rk <= {n}"""


def unrated(src, rated):
    return f"(SELECT * FROM {src} p WHERE NOT EXISTS (SELECT 1 FROM {rated} r WHERE r.user_id = p.user_id AND r.item_id = p.item_id))"


def rmse_sql(rows, group=""):
    sel = f"{group}, " if group else ""
    grp = f" GROUP BY {group}" if group else ""
    return f"""SELECT {sel}COUNT(*) AS hits,
  round(sqrt(avg((predicted_rating - rating) * (predicted_rating - rating))), 6) AS rmse
FROM {rows}{grp}"""


W = "WITH "
ORD = W + R_ORDERS + ",\n" + SPLIT
EVT = W + R_EVENTS + ",\n" + SPLIT


def _profiles(ent, oth, n_oth):
    counts = ",\n  ".join(
        f"CAST(SUM(CASE WHEN least(5, greatest(0, floor(rating))) = {v} THEN 1 ELSE 0 END) AS BIGINT) AS n_rated_{v}"
        for v in range(6))
    return f"""{ORD}
SELECT {ent}, COUNT(*) AS n_ratings, COUNT(DISTINCT {oth}) AS {n_oth}, AVG(rating) AS mean_rating,
  round(stddev_samp(rating), 6) AS std_rating, MIN(rating) AS min_rating, MAX(rating) AS max_rating,
  COUNT(DISTINCT rating) AS n_distinct_ratings,
  {counts}
FROM train GROUP BY {ent}"""


CONST = """s AS (SELECT user_id, COUNT(*) AS rating_count, stddev_samp(rating) AS std_rating
      FROM ratings GROUP BY user_id),
c AS (SELECT * FROM s WHERE std_rating IS NULL OR std_rating = 0)"""

BIASED = """b AS (SELECT user_id, COUNT(DISTINCT rating) AS distinct_ratings, COUNT(DISTINCT item_id) AS num_rated_items
      FROM ratings GROUP BY user_id)"""

OV_NB = f"""{ORD},
{stats()},
{overlap()},
{neighbours()}"""


def _sweep_tail(cent, means, test, item_filter, k_sql):
    """Per-n predictions from ``nb`` (ranked up to the sweep's top n), best
    k per (n, user), RMSE over the test hits, one row per n."""
    lo, hi = SWEEP
    return f"""ns AS (SELECT CAST(range AS INTEGER) AS n FROM range({lo}, {hi + 1})),
sw_a AS (
  SELECT ns.n, nb.user_id, c.item_id, SUM(nb.similarity * c.centered) AS num, SUM(abs(nb.similarity)) AS den
  FROM nb JOIN {cent} c ON c.user_id = nb.neighbour_id JOIN ns ON nb."rank" <= ns.n
  {item_filter}
  GROUP BY ns.n, nb.user_id, c.item_id),
sw_p AS (
  SELECT a.n, a.user_id, a.item_id, round(m.mean_rating + a.num / a.den, 6) AS predicted_rating
  FROM sw_a a JOIN {means} m ON m.user_id = a.user_id WHERE a.den > 0),
sw_k AS ({k_sql}),
sw_b AS (
  SELECT x.* FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY n, user_id ORDER BY predicted_rating DESC, item_id) AS rk
                   FROM sw_p) x JOIN sw_k ON sw_k.user_id = x.user_id WHERE x.rk <= sw_k.k),
sw_h AS (SELECT b.n, b.predicted_rating, t.rating FROM sw_b b JOIN {test} t ON t.user_id = b.user_id AND t.item_id = b.item_id),
per AS ({rmse_sql('sw_h', 'n')}),
sweep AS (SELECT ns.n, CAST(COALESCE(per.hits, 0) AS BIGINT) AS hits, per.rmse FROM ns LEFT JOIN per ON per.n = ns.n),
best AS (SELECT * FROM sweep WHERE rmse IS NOT NULL ORDER BY rmse ASC, n ASC LIMIT 1)"""


def _sweep_ctes():
    return f"""{ORD},
{stats()},
{overlap()},
{neighbours(n=SWEEP[1])},
{_sweep_tail('cent', 'ust', 'test', 'WHERE c.item_id IN (SELECT item_id FROM test)',
             f'SELECT DISTINCT user_id, {TOP} AS k FROM test')}"""


def _sweep_corated_ctes():
    unrated_filter = ("WHERE NOT EXISTS (SELECT 1 FROM valid r WHERE r.user_id = nb.user_id "
                      "AND r.item_id = c.item_id)")
    return f"""{ORD},
{VALID},
{corated()},
tu AS (SELECT DISTINCT user_id FROM test WHERE user_id IN (SELECT user_id FROM vs)),
vtest AS (SELECT * FROM test WHERE user_id IN (SELECT user_id FROM tu)),
{_r1b('sims', 'SELECT user_id FROM tu', 'SELECT COUNT(*) FROM vs', n=SWEEP[1])},
{stats(src='valid')},
{_sweep_tail('cent', 'ust', 'vtest', unrated_filter,
             'SELECT user_id, COUNT(*) AS k FROM vtest GROUP BY user_id')}"""


def _knn_cells(cells, ent, oth, cent, sims, means, k=K_RATERS):
    """Score ``cells`` (ent, oth) by the k most similar raters (R4 + R6)."""
    return f"""kc AS (
  SELECT x.{ent}, x.{oth}, c.{ent} AS neighbour_id, c.centered
  FROM {cells} x JOIN {cent} c ON c.{oth} = x.{oth} WHERE c.{ent} <> x.{ent}),
ks AS (
  SELECT {ent}, neighbour_id, similarity FROM {sims} WHERE similarity <> 0
  UNION ALL SELECT neighbour_id AS {ent}, {ent} AS neighbour_id, similarity FROM {sims} WHERE similarity <> 0),
kj AS (
  SELECT kc.*, COALESCE(ks.similarity, {D(0)}) AS similarity
  FROM kc LEFT JOIN ks ON ks.{ent} = kc.{ent} AND ks.neighbour_id = kc.neighbour_id),
kt AS (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {ent}, {oth} ORDER BY similarity DESC, neighbour_id ASC) AS rk
                 FROM kj) x WHERE rk <= {k}),
ka AS (SELECT {ent}, {oth}, SUM(similarity * centered) AS num, SUM(abs(similarity)) AS den FROM kt GROUP BY {ent}, {oth}),
kp AS (
  SELECT x.*, round(greatest({D(CLIP_LOW)}, least({D(CLIP_HIGH)},
           COALESCE(m.mean_rating, {D(0)}) + COALESCE(a.num, {D(0)}) / (COALESCE(a.den, {D(0)}) + {KNN_EPSILON!r}))), 6)
         AS predicted_rating
  FROM {cells} x LEFT JOIN ka a ON a.{ent} = x.{ent} AND a.{oth} = x.{oth}
  LEFT JOIN {means} m ON m.{ent} = x.{ent})"""


def _knn_test(form=ORD):
    return f"""{form},
{stats()},
{cosine()},
{_knn_cells('test', 'user_id', 'item_id', 'cent', 'sims', 'ust')}"""


def _knn_catalogue(ent, oth):
    cells = f"""cells AS (
  SELECT e.{ent}, o.{oth} FROM (SELECT DISTINCT {ent} FROM train) e, (SELECT DISTINCT {oth} FROM train) o
  WHERE NOT EXISTS (SELECT 1 FROM train r WHERE r.{ent} = e.{ent} AND r.{oth} = o.{oth}))"""
    return f"""{EVT},
{stats(ent=ent, oth=oth)},
{cosine(ent=ent, oth=oth)},
{cells},
{_knn_cells('cells', ent, oth, 'cent', 'sims', 'ust')}
{top('kp', N_RECOMMEND, ent=ent, oth=oth)}"""


def _r1b(sims, targets_sql, n_valid_sql, directed=False, name="nb", n=N_NEIGHBOURS):
    mirror_part = "" if directed else f"""
  UNION ALL SELECT neighbour_id AS user_id, user_id AS neighbour_id, similarity FROM {sims} WHERE similarity <> 0"""
    return f"""{name}_s AS (
  SELECT user_id, neighbour_id, similarity FROM {sims} WHERE similarity <> 0{mirror_part}),
{name}_r AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, similarity > 0
           ORDER BY CASE WHEN similarity > 0 THEN -similarity ELSE similarity END,
                    CASE WHEN similarity > 0 THEN neighbour_id ELSE -neighbour_id END) AS rn
  FROM {name}_s WHERE user_id IN ({targets_sql})),
{name} AS (
  SELECT user_id, neighbour_id, similarity,
         CAST(CASE WHEN similarity > 0 THEN rn ELSE ({n_valid_sql}) - 1 - rn + 1 END AS INTEGER) AS "rank"
  FROM {name}_r
  WHERE CASE WHEN similarity > 0 THEN rn ELSE ({n_valid_sql}) - 1 - rn + 1 END <= {n})"""


SQL: dict[str, str] = {
    "ratings_load": f"{W}{R_ORDERS}\nSELECT user_id, item_id, rating FROM ratings",
    "utility_matrix": """SELECT o_custkey AS user_id, l_partkey AS item_id,
  CAST(SUM(CAST(CAST(1 + floor((l_quantity - 1) / 10) AS BIGINT) AS DOUBLE)) AS DOUBLE) AS rating,
  COUNT(*) AS n_events
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_partkey""",
    "ratings_profile": f"""{W}{R_ORDERS}
SELECT COUNT(*) AS n_ratings, COUNT(DISTINCT user_id) AS n_users, COUNT(DISTINCT item_id) AS n_items,
  MAX(user_id) AS max_user_id, MAX(item_id) AS max_item_id, AVG(rating) AS mean_rating,
  MIN(rating) AS min_rating, MAX(rating) AS max_rating FROM ratings""",
    "split_train": f"{ORD}\nSELECT user_id, item_id, rating FROM train",
    "split_test": f"{ORD}\nSELECT user_id, item_id, rating FROM test",
    "user_means": f"""{ORD}
SELECT user_id, COUNT(*) AS n, SUM(rating) AS rating_sum, AVG(rating) AS mean_rating FROM train GROUP BY user_id""",
    "ratings_centered": f"""{ORD},
{stats()}
SELECT user_id, item_id, rating, mean_rating, centered FROM cent""",
    "user_profiles": _profiles("user_id", "item_id", "n_items"),
    "item_profiles": _profiles("item_id", "user_id", "n_users"),
    "constant_raters": f"""{W}{R_ORDERS},
{CONST}
SELECT user_id, rating_count, std_rating FROM c""",
    "constant_rater_summary": f"""{W}{R_ORDERS},
{CONST}
SELECT COUNT(*) AS total_users,
  CAST(SUM(CASE WHEN std_rating IS NULL OR std_rating = 0 THEN 1 ELSE 0 END) AS BIGINT) AS constant_users,
  round(AVG(CASE WHEN std_rating IS NULL OR std_rating = 0 THEN {D(1)} ELSE {D(0)} END) * {D(100)}, 6) AS percent
FROM s""",
    "constant_rater_values": f"""{W}{R_ORDERS},
{CONST}
SELECT DISTINCT r.user_id, c.rating_count, r.rating FROM ratings r JOIN c ON c.user_id = r.user_id""",
    "ratings_without_constant": f"""{W}{R_ORDERS},
{CONST}
SELECT user_id, item_id, rating FROM ratings WHERE user_id NOT IN (SELECT user_id FROM c)""",
    "biased_raters": f"""{W}{R_ORDERS},
{BIASED}
SELECT user_id, distinct_ratings, num_rated_items FROM b
WHERE distinct_ratings = 1 OR num_rated_items <= {BIASED_MAX_ITEMS}""",
    "biased_rater_summary": f"""{W}{R_ORDERS},
{BIASED}
SELECT COUNT(*) AS total_users,
  CAST(SUM(CASE WHEN distinct_ratings = 1 OR num_rated_items <= {BIASED_MAX_ITEMS} THEN 1 ELSE 0 END) AS BIGINT)
    AS biased_users,
  round(AVG(CASE WHEN distinct_ratings = 1 OR num_rated_items <= {BIASED_MAX_ITEMS} THEN {D(1)} ELSE {D(0)} END)
        * {D(100)}, 6) AS percent
FROM b""",
    "co_rated_pairs": f"""{ORD}
SELECT a.user_id, b.user_id AS neighbour_id, COUNT(*) AS n_common
FROM train a JOIN train b ON a.item_id = b.item_id AND a.user_id < b.user_id GROUP BY a.user_id, b.user_id""",
    "similarity_corated": f"""{ORD},
{VALID},
{corated()}
SELECT user_id, neighbour_id, n_common, similarity FROM sims""",
    "similarity_overlap": f"""{ORD},
{stats()},
{overlap()}
SELECT user_id, neighbour_id, n_common, similarity FROM sims""",
    "similarity_cosine": f"""{ORD},
{stats()},
{cosine()}
SELECT user_id, neighbour_id, n_common, similarity FROM sims""",
    "similarity_above": f"""{EVT},
{stats()},
{overlap()}
SELECT user_id, neighbour_id, n_common, similarity FROM sims WHERE similarity > {THRESHOLD}""",
    "similarity_above_cosine": f"""{EVT},
{stats()},
{cosine()}
SELECT user_id, neighbour_id, n_common, similarity FROM sims WHERE similarity > {DEMO_THRESHOLD}""",
    "top_neighbours_events": f"""{EVT},
{stats()},
{overlap()},
s2 AS (SELECT user_id, neighbour_id, similarity FROM sims WHERE similarity > {THRESHOLD}
  UNION ALL SELECT neighbour_id, user_id, similarity FROM sims WHERE similarity > {THRESHOLD}),
r2 AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY similarity DESC, neighbour_id) AS rk FROM s2)
SELECT user_id, neighbour_id, similarity, CAST(rk AS INTEGER) AS "rank" FROM r2 WHERE rk <= {N_NEIGHBOURS}""",
    "similarity_item_cosine": f"""{ORD},
{stats(name='ist', cname='icent', ent='item_id', oth='user_id')},
{cosine(cent='icent', ent='item_id', oth='user_id')}
SELECT item_id, neighbour_id, n_common, similarity FROM sims""",
    "similarity_symmetric": f"""{ORD},
{stats()},
{overlap()}
SELECT user_id, neighbour_id, n_common, similarity FROM sims
UNION ALL SELECT neighbour_id, user_id, n_common, similarity FROM sims
UNION ALL SELECT DISTINCT user_id, user_id, CAST(NULL AS BIGINT), {D(1)} FROM train""",
    "top_neighbours": f"""{OV_NB}
SELECT user_id, neighbour_id, similarity, "rank" FROM nb""",
    "top_neighbours_all": f"""{ORD},
{VALID},
{corated()},
{_r1b('sims', 'SELECT user_id FROM test', 'SELECT COUNT(*) FROM vs')}
SELECT user_id, neighbour_id, similarity, "rank" FROM nb""",
    "predict_user_knn": f"""{OV_NB},
{predict()}
SELECT user_id, item_id, predicted_rating FROM pred""",
    "predict_test_items": f"""{OV_NB},
{predict(item_filter='WHERE c.item_id IN (SELECT item_id FROM test)')}
SELECT user_id, item_id, predicted_rating FROM pred""",
    "recommend_top_n": f"""{OV_NB},
{predict()}
{top(unrated('pred', 'train'), TOP)}""",
    "unrated_items": f"""{OV_NB},
u AS (SELECT nb.user_id, t.item_id, COUNT(*) AS n_neighbours
      FROM nb JOIN train t ON t.user_id = nb.neighbour_id GROUP BY nb.user_id, t.item_id)
SELECT user_id, item_id, n_neighbours FROM {unrated('u', 'train')} z""",
    "user_history": f"""{ORD},
h AS (SELECT user_id, item_id, rating FROM test
      UNION ALL SELECT user_id, item_id, rating FROM train WHERE user_id NOT IN (SELECT user_id FROM test)),
hc AS (SELECT user_id, COUNT(*) AS n_rated FROM h GROUP BY user_id)
SELECT h.user_id, hc.n_rated, h.item_id, h.rating FROM h JOIN hc ON hc.user_id = h.user_id""",
    "predict_uncentered": f"""{OV_NB}
SELECT nb.user_id, t.item_id, round(SUM(nb.similarity * t.rating) / SUM(nb.similarity), 6) AS predicted_rating
FROM nb JOIN train t ON t.user_id = nb.neighbour_id
GROUP BY nb.user_id, t.item_id HAVING SUM(nb.similarity) <> 0""",
    "recommend_with_history": f"""{ORD},
{stats()},
{overlap()},
{neighbours(t=DEMO_THRESHOLD, targets=None)},
{predict(item_filter='WHERE c.item_id IN (SELECT item_id FROM test)')},
hist AS (SELECT user_id, item_id FROM test
         UNION ALL SELECT user_id, item_id FROM train WHERE user_id NOT IN (SELECT user_id FROM test)),
kept AS (SELECT user_id, item_id, predicted_rating FROM {unrated('pred', 'hist')} z)
{top('kept', TOP)}""",
    "recommend_single_user": f"""{ORD},
{VALID},
one AS (SELECT * FROM valid WHERE user_id = (SELECT MIN(user_id) FROM valid)),
{corated(src='one', other='valid')},
{_r1b('sims', 'SELECT user_id FROM one', 'SELECT COUNT(*) FROM vs', directed=True)},
{stats(src='valid')},
{predict()}
{top(unrated('pred', 'valid'), TOP)}""",
    "recommend_for_vector": f"""{ORD},
vec AS (SELECT -1 - user_id AS user_id, item_id, rating FROM test
        WHERE user_id = (SELECT MIN(user_id) FROM test)),
{stats(src='vec', name='vst', cname='vcent')},
{stats()},
{overlap(cent='vcent', other='cent')},
{neighbours(targets=None, directed=True)},
{predict(means='vst')}
{top(unrated('pred', 'vec'), TOP)}""",
    "rmse": f"""{OV_NB},
{predict(item_filter='WHERE c.item_id IN (SELECT item_id FROM test)')},
t5 AS ({top('pred', TOP)}),
hit AS (SELECT p.predicted_rating, t.rating FROM t5 p JOIN test t ON t.user_id = p.user_id AND t.item_id = p.item_id)
{rmse_sql('hit')}""",
    "rmse_by_n": f"""{_sweep_ctes()}
SELECT n, hits, rmse FROM sweep""",
    "rmse_by_n_corated": f"""{_sweep_corated_ctes()}
SELECT n, hits, rmse FROM sweep""",
    "best_n": f"""{_sweep_ctes()}
SELECT n, hits, rmse FROM best""",
    "recommend_final": f"""{_sweep_ctes()},
{stats(src='ratings', name='ast', cname='acent')},
{overlap(cent='acent', name='asims')},
{neighbours(sims='asims', name='anb', n='(SELECT n FROM best)', targets=None)},
{predict(nb='anb', cent='acent', means='ast', name='apred')}
{top(unrated('apred', 'ratings'), TOP)}""",
    "predict_nbcf": f"""{_knn_test(EVT)}
SELECT user_id, item_id, rating, predicted_rating FROM kp""",
    "predict_nbcf_items": f"""{EVT},
{stats(ent='item_id', oth='user_id')},
{cosine(ent='item_id', oth='user_id')},
{_knn_cells('test', 'item_id', 'user_id', 'cent', 'sims', 'ust')}
SELECT user_id, item_id, rating, predicted_rating FROM kp""",
    "nbcf_evaluate": f"""{_knn_test(EVT)}
SELECT COUNT(*) AS n_cells,
  round(sqrt(avg((predicted_rating - rating) * (predicted_rating - rating))), 6) AS rmse FROM kp""",
    "rmse_by_fraction": f"""{_knn_test(EVT)}
SELECT f.fraction, COUNT(*) AS n_cells,
  round(sqrt(avg((predicted_rating - rating) * (predicted_rating - rating))), 6) AS rmse
FROM kp JOIN (VALUES {", ".join(f"({f})" for f in FRACTIONS)}) f(fraction)
  ON ((kp.user_id % 100) * {SAMPLE_USER_MULT} + (kp.item_id % 100) * {SAMPLE_ITEM_MULT}) % 100 < f.fraction
GROUP BY f.fraction""",
    "recommend_nbcf": _knn_catalogue("user_id", "item_id"),
    "recommend_users_for_item": _knn_catalogue("item_id", "user_id"),
}


for _k in ("constant_raters", "constant_rater_summary", "constant_rater_values", "ratings_without_constant", "biased_raters",
           "biased_rater_summary"):
    SQL[f"{_k}_baskets"] = SQL[_k].replace(R_ORDERS, R_BASKETS)

SQL["similarity_corated_baskets"] = f"""{W}{R_BASKETS},
{CONST},
valid AS (SELECT item_id AS user_id, user_id AS item_id, rating FROM ratings WHERE user_id NOT IN (SELECT user_id FROM c)),
{corated()}
SELECT user_id AS item_id, neighbour_id, n_common, similarity FROM sims"""

SQL["als_cells"] = f"""{ORD}
SELECT COUNT(*) AS n_cells,
  CAST(SUM(CASE WHEN user_id IN (SELECT user_id FROM train) AND item_id IN (SELECT item_id FROM train) THEN 1 ELSE 0 END) AS BIGINT) AS hits,
  CAST(0 AS BIGINT) AS out_of_range
FROM test"""

SQL["als_recommend_counts"] = f"""{ORD}
SELECT user_id, least({N_RECOMMEND}, (SELECT COUNT(DISTINCT item_id) FROM train) - COUNT(*)) AS n_items, CAST(0 AS BIGINT) AS n_rated_items
FROM train GROUP BY user_id HAVING (SELECT COUNT(DISTINCT item_id) FROM train) > COUNT(*)"""


def _als_start(col, name):
    """First factors at rank 2, from the ids."""
    value = lambda a: f"((((({col} % 9973 + 9973) % 9973) * {31 + 2 * a} + {17 * a}) % 101 + 11) / 111.0 / sqrt(CAST(2 AS DOUBLE)))"
    return f"{name} AS MATERIALIZED (SELECT {col}, {value(0)} AS f0, {value(1)} AS f1 FROM (SELECT DISTINCT {col} FROM train) d)"


def _als_step(by, other, source, name):
    """The 2 x 2 ridge solves of one side."""
    return f"""{name} AS MATERIALIZED (
  SELECT {by}, (b0 * a11 - b1 * a01) / (a00 * a11 - a01 * a01) AS f0, (b1 * a00 - b0 * a01) / (a00 * a11 - a01 * a01) AS f1
  FROM (SELECT c.{by}, sum(f0 * f0) + {ALS_REG} * count(*) AS a00, sum(f0 * f1) AS a01, sum(f1 * f1) + {ALS_REG} * count(*) AS a11,
          sum(centered * f0) AS b0, sum(centered * f1) AS b1
        FROM cent c JOIN {source} s ON s.{other} = c.{other} GROUP BY c.{by}) n)"""


def _als_loss(i, x, w):
    """The loss of two sides, every cell of the matrix that is not rated counting as 0."""
    gram = lambda t: f"(SELECT sum(f0 * f0) AS a, sum(f0 * f1) AS b, sum(f1 * f1) AS c FROM {t})"
    return f"""SELECT CAST({i} AS INTEGER) AS iteration, round(sqrt(greatest(0, o.yy - 2 * o.yf + x.a * w.a + 2 * x.b * w.b + x.c * w.c))
    / (2 * (SELECT count(*) FROM ust)) + {ALS_REG} * (sqrt(x.a + x.c) + sqrt(w.a + w.c)), 6) AS loss
  FROM (SELECT sum(centered * centered) AS yy, sum(centered * (x.f0 * w.f0 + x.f1 * w.f1)) AS yf
        FROM cent c JOIN {x} x ON x.user_id = c.user_id JOIN {w} w ON w.item_id = c.item_id) o, {gram(x)} x, {gram(w)} w"""


for _k in ("ratings_csv", "ratings_csv_inferred", "ratings_tsv"):
    SQL[_k] = SQL["ratings_load"]

SQL["similarity_incremental"] = SQL["similarity_overlap"]
SQL["recommend_stored"] = SQL["recommend_top_n"]

SQL["split_files"] = f"""{ORD}
SELECT user_id, item_id, rating, 'train' AS side FROM train UNION ALL SELECT user_id, item_id, rating, 'test' AS side FROM test"""

_EXACT = f"""{W}{R_ORDERS},
h AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY md5(':' || CAST(user_id AS VARCHAR) || ':' || CAST(item_id AS VARCHAR)), item_id) AS r,
  count(*) OVER (PARTITION BY user_id) AS n FROM ratings)
SELECT user_id, item_id, rating FROM h WHERE r """
SQL["split_exact_train"] = f"{_EXACT}> n * {TEST_PERCENT} // 100"
SQL["split_exact_test"] = f"{_EXACT}<= n * {TEST_PERCENT} // 100"


def _chunks(ent, oth):
    return f"""{ORD},
cat AS (SELECT {oth}, row_number() OVER (ORDER BY {oth}) AS pos FROM (SELECT DISTINCT {oth} FROM train) x)
SELECT {ent}, CAST((pos - 1) // 64 AS BIGINT) AS chunk, COUNT(*) AS n_ratings,
  string_agg(CAST(t.{oth} AS VARCHAR), ',' ORDER BY t.{oth}) AS ids,
  string_agg(CAST(CAST(rating AS BIGINT) AS VARCHAR), ',' ORDER BY t.{oth}) AS ratings
FROM train t JOIN cat ON cat.{oth} = t.{oth} GROUP BY {ent}, (pos - 1) // 64"""


SQL["user_profile_chunks"] = _chunks("user_id", "item_id")
SQL["item_profile_chunks"] = _chunks("item_id", "user_id")

SQL["unrated_gaps"] = f"""{ORD},
cat AS (SELECT item_id, row_number() OVER (ORDER BY item_id) AS pos FROM (SELECT DISTINCT item_id FROM train) x),
p AS (SELECT t.user_id, cat.pos FROM train t JOIN cat ON cat.item_id = t.item_id
  UNION ALL SELECT DISTINCT user_id, (SELECT count(*) + 1 FROM cat) FROM train),
g AS (SELECT user_id, coalesce(lag(pos) OVER (PARTITION BY user_id ORDER BY pos), 0) + 1 AS f, pos - 1 AS l FROM p)
SELECT g.user_id, a.item_id AS first_item_id, b.item_id AS last_item_id, CAST(l - f + 1 AS BIGINT) AS n_items
FROM g JOIN cat a ON a.pos = g.f JOIN cat b ON b.pos = g.l WHERE l >= f"""

SQL["similarity_by_function"] = f"""{ORD},
{stats()}
SELECT a.user_id, b.user_id AS neighbour_id, COUNT(*) AS n_common,
  round(SUM(a.dev * b.dev) / (1.0 + sqrt(SUM(a.dev * a.dev)) * sqrt(SUM(b.dev * b.dev))), 6) AS similarity
FROM cent a JOIN cent b ON a.item_id = b.item_id AND a.user_id < b.user_id GROUP BY a.user_id, b.user_id"""

SQL["als_loss_trace_rank2"] = f"""{ORD},
{stats()},
{_als_start('user_id', 'x0')},
{_als_start('item_id', 'w0')},
{_als_step('user_id', 'item_id', 'w0', 'x1')},
{_als_step('item_id', 'user_id', 'x1', 'w1')},
{_als_step('user_id', 'item_id', 'w1', 'x2')},
{_als_step('item_id', 'user_id', 'x2', 'w2')}
{_als_loss(0, 'x0', 'w0')} UNION ALL
{_als_loss(1, 'x1', 'w1')} UNION ALL
{_als_loss(2, 'x2', 'w2')}"""


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
