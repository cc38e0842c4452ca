"""Ratings sources.

Every reader returns the canonical long table ``user_id bigint,
item_id bigint, rating double`` with only the needed columns read, so
Parquet scans prune to those columns and push filters down.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinrank.schema import ITEM, RATING, RATINGS_TSV_SCHEMA, USER, ratings_csv_schema


def canonical(df: DataFrame, user: str = USER, item: str = ITEM, rating: str = RATING) -> DataFrame:
    return df.select(F.col(user).cast("bigint").alias(USER),
                     F.col(item).cast("bigint").alias(ITEM),
                     F.col(rating).cast("double").alias(RATING))


def read_ratings_csv(spark: SparkSession, path: str, infer_schema: bool = False,
                     user: str = "user", item: str = "item", rating: str = "rating") -> DataFrame:
    """Ratings CSV with a header (S1): index, then the named columns, as 64-bit
    ids and double ratings. A row that does not parse fails the read rather
    than becoming a null user. ``infer_schema=True`` (S2) costs an extra pass
    over the file and finds the columns by name anywhere."""
    reader = spark.read.option("header", True).option("mode", "FAILFAST")
    reader = reader.option("inferSchema", True) if infer_schema else reader.schema(ratings_csv_schema(user, item, rating))
    return canonical(reader.csv(path), user, item, rating)


def read_ratings_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Headerless tab-separated ``user, item, rating, unix_timestamp`` (S3);
    the timestamp is dropped."""
    df = spark.read.option("sep", "\t").option("header", False).option("mode", "FAILFAST").schema(RATINGS_TSV_SCHEMA).csv(path)
    return canonical(df)


def write_ratings_csv(ratings: DataFrame, path: str) -> str:
    """Ratings as the CSV that ``read_ratings_csv`` reads: index, user, item,
    rating with a header in every part file."""
    (ratings.select(F.monotonically_increasing_id().alias("index"), F.col(USER).alias("user"), F.col(ITEM).alias("item"), F.col(RATING).alias("rating"))
     .write.option("header", True).csv(path))
    return path


def write_ratings_tsv(ratings: DataFrame, path: str) -> str:
    """Ratings as the headerless TSV that ``read_ratings_tsv`` reads (no time: 0)."""
    ratings.select(USER, ITEM, RATING, F.lit(0).cast("long").alias("t")).write.option("sep", "\t").option("header", False).csv(path)
    return path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quantity_rating(quantity_col: str = "l_quantity"):
    """Map an order-line quantity 1..50 onto a 1..5 rating."""
    return (F.lit(1) + F.floor((F.col(quantity_col) - F.lit(1)) / F.lit(10))).cast("bigint")


def purchase_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rating event per order line: customer rates part by quantity.
    Duplicate (customer, part) events remain; see ``utility_matrix``."""
    li = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    o = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    return j.select(F.col("o_custkey").alias(USER), F.col("l_partkey").alias(ITEM),
                    quantity_rating().cast("double").alias(RATING))


def ratings_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders form: a customer's rating of a part is the highest quantity
    rating over all their order lines of that part."""
    return utility_matrix(purchase_events(spark, sf_dir), policy="max").select(USER, ITEM, RATING)


def ratings_from_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baskets form: an order's rating of a part is the highest quantity rating
    over its lines of that part. Orders are short, so many rate constantly."""
    li = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    lines = li.select(F.col("l_orderkey").alias(USER), F.col("l_partkey").alias(ITEM),
                      quantity_rating().cast("double").alias(RATING))
    return utility_matrix(lines, policy="max").select(USER, ITEM, RATING)


def ratings_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events form: ``item_id = props.k``, rating ``min(5, 1 + floor(value/10))``,
    highest per (user, item)."""
    ev = _table(spark, sf_dir, "events").select("user_id", "props", "value")
    item = F.get_json_object("props", "$.k").cast("bigint")
    rating = F.least(F.lit(5), (F.lit(1) + F.floor(F.col("value") / F.lit(10))).cast("bigint"))
    r = (ev.select(F.col("user_id").alias(USER), item.alias(ITEM), rating.alias("_r"))
         .where(F.col(ITEM).isNotNull() & F.col("_r").isNotNull() & F.col(USER).isNotNull()))
    return r.groupBy(USER, ITEM).agg(F.max("_r").cast("double").alias(RATING))


_POLICIES = {"sum": F.sum, "max": F.max, "min": F.min, "mean": F.avg}


def utility_matrix(events: DataFrame, policy: str = "sum") -> DataFrame:
    """One cell per (user, item) (S4). Duplicate events are merged by
    ``policy`` (``sum`` is what a sparse-matrix build does with repeated
    coordinates). Partial aggregation runs map-side before the shuffle."""
    agg = _POLICIES[policy]
    return events.groupBy(USER, ITEM).agg(agg(RATING).cast("double").alias(RATING),
                                          F.count(F.lit(1)).alias("n_events"))


def ratings_profile(ratings: DataFrame) -> DataFrame:
    """Dataset profile (S6): one aggregate pass."""
    return ratings.agg(F.count(F.lit(1)).alias("n_ratings"),
                       F.countDistinct(USER).alias("n_users"),
                       F.countDistinct(ITEM).alias("n_items"),
                       F.max(USER).alias("max_user_id"),
                       F.max(ITEM).alias("max_item_id"),
                       F.avg(RATING).alias("mean_rating"),
                       F.min(RATING).alias("min_rating"),
                       F.max(RATING).alias("max_rating"))
