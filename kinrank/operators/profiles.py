"""Whole profile vectors (A1b) and catalogue-wide unrated items (J8), in bounded rows.

Both work on positions in a dense index of the catalogue. A profile is cut into
chunks of ``CHUNK`` positions, so a row holds at most that many ratings however
many an entity has, and two profiles meet chunk by chunk. What an entity has not
rated is the complement of its positions: one row a gap, found within a chunk and
between an entity's chunks, never a row a missing cell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinrank.operators.indexing import dense_index
from kinrank.schema import ITEM, NEIGHBOUR, RATING, USER
from kinrank.session import materialize

CHUNK = 4096                          # positions of a chunk: ratings of a row at most


def _placed(ratings: DataFrame, entity: str, through: str, chunk: int, catalogue: DataFrame | None) -> DataFrame:
    cat = catalogue if catalogue is not None else dense_index(ratings, through, "_at")
    return (ratings.select(entity, through, RATING).join(cat, through)
            .withColumn("chunk", F.floor((F.col("_at") - 1) / F.lit(chunk)).cast("long")))


def profile_chunks(ratings: DataFrame, entity: str = USER, through: str = ITEM, chunk: int = CHUNK,
                   catalogue: DataFrame | None = None) -> DataFrame:
    """``entity, chunk, n_ratings, ids, ratings``: all of an entity's ratings as
    sparse vectors of at most ``chunk`` ids each, ids ascending. One row per
    (entity, through) cell is expected. ``catalogue`` (``through, _at``) numbers
    the ids; by default those rated, from 1."""
    rows = _placed(ratings, entity, through, chunk, catalogue)
    cells = F.sort_array(F.collect_list(F.struct(F.col(through).alias("id"), F.col(RATING).alias("rating"))))
    return (rows.groupBy(entity, "chunk").agg(F.count(F.lit(1)).alias("n_ratings"), cells.alias("_c"))
            .select(entity, "chunk", "n_ratings", F.col("_c.id").alias("ids"), F.col("_c.rating").alias("ratings")))


def profile_dots(chunks: DataFrame, pairs: DataFrame, entity: str = USER) -> DataFrame:
    """``entity, neighbour_id, n_common, dot`` of the asked pairs, chunk by
    chunk; pairs without a common id are left out."""
    left = chunks.select(entity, "chunk", F.map_from_arrays("ids", "ratings").alias("_m"))
    right = chunks.select(F.col(entity).alias(NEIGHBOUR), "chunk", F.col("ids").alias("_i"), F.col("ratings").alias("_r"))
    both = pairs.select(entity, NEIGHBOUR).distinct().join(left, entity).join(right, [NEIGHBOUR, "chunk"])
    common = F.filter(F.transform(F.arrays_zip("_i", "_r"), lambda c: F.struct(F.col("_m")[c["_i"]].alias("a"), c["_r"].alias("b"))),
                      lambda c: c["a"].isNotNull())
    part = both.select(entity, NEIGHBOUR, F.size(common).alias("n"), F.aggregate(common, F.lit(0.0), lambda s, c: s + c["a"] * c["b"]).alias("d"))
    return (part.groupBy(entity, NEIGHBOUR).agg(F.sum("n").cast("long").alias("n_common"), F.sum("d").alias("dot"))
            .where(F.col("n_common") > 0))


def unrated_gaps(ratings: DataFrame, entity: str = USER, through: str = ITEM, chunk: int = CHUNK) -> DataFrame:
    """``entity, first_<through>, last_<through>, n_items``: the runs of
    catalogue entries an entity has not rated, a row a gap; the catalogue is
    every rated ``through``, in ascending order.

    Gaps inside a chunk come from a window over at most ``chunk`` rows; those
    between chunks, and the two at the ends, from a window over the entity's
    chunks, of which there are at most catalogue / ``chunk``."""
    cat = materialize(dense_index(ratings, through, "_at"))
    total = cat.count()                                                     # one scalar
    rows = _placed(ratings.select(entity, through, RATING).dropDuplicates([entity, through]), entity, through, chunk, cat).select(entity, "chunk", "_at")
    inside = rows.withColumn("_b", F.lag("_at").over(Window.partitionBy(entity, "chunk").orderBy("_at")))
    inside = inside.where(F.col("_at") > F.col("_b") + 1).select(entity, (F.col("_b") + 1).alias("_f"), (F.col("_at") - 1).alias("_l"))
    ends = rows.groupBy(entity, "chunk").agg(F.min("_at").alias("_lo"), F.max("_at").alias("_hi"))
    order = Window.partitionBy(entity).orderBy("chunk")
    ends = (ends.withColumn("_b", F.coalesce(F.lag("_hi").over(order), F.lit(0)))
            .withColumn("_last", F.lead("_hi").over(order).isNull()))
    between = ends.where(F.col("_lo") > F.col("_b") + 1).select(entity, (F.col("_b") + 1).alias("_f"), (F.col("_lo") - 1).alias("_l"))
    after = (ends.where(F.col("_last") & (F.col("_hi") < F.lit(total)))
             .select(entity, (F.col("_hi") + 1).alias("_f"), F.lit(total).cast("long").alias("_l")))
    gaps = inside.unionByName(between).unionByName(after)
    name = lambda at, out: cat.select(F.col("_at").alias(at), F.col(through).alias(out))
    return (gaps.join(name("_f", f"first_{through}"), "_f").join(name("_l", f"last_{through}"), "_l")
            .select(entity, f"first_{through}", f"last_{through}", (F.col("_l") - F.col("_f") + 1).alias("n_items")))


def expand_gaps(gaps: DataFrame, ratings: DataFrame, entity: str = USER, through: str = ITEM) -> DataFrame:
    """``entity, through``: every unrated cell of some gaps, for callers that
    need single cells (filter the gaps first)."""
    cat = dense_index(ratings, through, "_at")
    of = lambda c, out: cat.select(F.col(through).alias(c), F.col("_at").alias(out))
    runs = gaps.join(of(f"first_{through}", "_f"), f"first_{through}").join(of(f"last_{through}", "_l"), f"last_{through}")
    return runs.select(entity, F.explode(F.sequence("_f", "_l")).alias("_at")).join(cat, "_at").select(entity, through)
