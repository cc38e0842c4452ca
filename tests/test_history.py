"""recommend_with_history (R8): users without test ratings fall back on their train rows."""

import duckdb
from pyspark.sql import functions as F

from kinrank.operators import evaluate
from kinrank.plans import catalog, oracle
from kinrank.schema import ITEM, USER

ITEMS = (0, 1, 2, 3, 4, 5, 8, 12, 15, 20)


def write_tables(spark, folder):
    """Six users rate ten parts alike; the last, 50, has train cells only."""
    n = F.col("id")
    cells = spark.createDataFrame([(u, i) for u in (0, 1, 2, 3, 4, 50) for i in ITEMS if u < 50 or i % 10 not in (1, 2)], "u long, p long").coalesce(1)
    lines = cells.withColumn("id", F.monotonically_increasing_id())
    lines.select((n + 1).alias("o_orderkey"), F.col("u").alias("o_custkey")).write.parquet(f"{folder}/orders.parquet")
    lines.select((n + 1).alias("l_orderkey"), F.col("p").alias("l_partkey"),
                 (F.pmod(F.col("u") + F.col("p") * F.col("p"), F.lit(50)) + 1).cast("double").alias("l_quantity")).write.parquet(f"{folder}/lineitem.parquet")


def test_users_without_test_ratings_fall_back_on_their_train_rows(spark, tmp_path):
    write_tables(spark, tmp_path)
    train, test = evaluate.split(catalog.orders_once(spark, str(tmp_path)))
    alone = {r[0] for r in train.select(USER).distinct().collect()} - {r[0] for r in test.select(USER).distinct().collect()}
    assert alone == {50}
    got = sorted(map(tuple, catalog.queries()["recommend_with_history"](spark, str(tmp_path)).collect()))
    assert any(r[0] in alone for r in got)
    mine = {r[0] for r in train.where(F.col(USER) == 50).select(ITEM).collect()}
    assert not mine & {r[1] for r in got if r[0] == 50}
    con = duckdb.connect()
    for t in ("orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    assert got == sorted(con.execute(oracle.oracle_sql()["recommend_with_history"]).fetchall())
