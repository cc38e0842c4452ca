"""Canonical column names and schemas."""

from pyspark.sql.types import DoubleType, LongType, StructField, StructType

USER = "user_id"
ITEM = "item_id"
RATING = "rating"
NEIGHBOUR = "neighbour_id"
SIM = "similarity"
PRED = "predicted_rating"

# Canonical ratings table.
RATINGS_SCHEMA = StructType([
    StructField(USER, LongType(), True),
    StructField(ITEM, LongType(), True),
    StructField(RATING, DoubleType(), True),
])

def ratings_csv_schema(user: str = "user", item: str = "item", rating: str = "rating") -> StructType:
    """Header CSV with an index column, as a ratings export usually comes.
    Fixed values: the layout and the default names of that file."""
    return StructType([
        StructField("index", LongType(), True),
        StructField(user, LongType(), True),
        StructField(item, LongType(), True),
        StructField(rating, DoubleType(), True),
    ])


# Headerless tab-separated ratings with a unix timestamp (S3).
RATINGS_TSV_SCHEMA = StructType([
    StructField(USER, LongType(), True),
    StructField(ITEM, LongType(), True),
    StructField(RATING, DoubleType(), True),
    StructField("unix_timestamp", LongType(), True),
])
