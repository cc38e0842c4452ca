"""The training-data pipeline: five stages, each one of the package's operators.

Every function takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's ``docs``. All but the last
return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinrank.llm import decontaminate, packing, simhash, substring_dedup, toxicity
from kinrank.llm.common import keyed, keys_are_unique, table
from kinrank.session import ensure_checkpoint_dir

#: The SQL for run()'s rows: a trained classifier and a tokenizer have none.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows scored below the threshold stay, as they are; null and empty texts
    score the share of toxic labels and equal texts alike. The classifier learns
    from labelled documents of this stage's input that aren't held out."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, carry=tuple(docs.columns), below=toxicity.THRESHOLD).select("carried.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of the smallest doc_id
    stays; of rows that repeat its id and text, one."""
    rows = keyed(docs)
    found = simhash.near_duplicates(rows.select("_k", "text"), id_col="_k")
    keep = found.where("doc_id = component_id").select(F.col("doc_id").alias("_k")).distinct()
    stay = rows.join(keep.hint("shuffle_hash"), "_k", "left_semi")
    if not keys_are_unique(docs):
        each = Window.partitionBy("_k").orderBy(F.xxhash64(*docs.columns))
        stay = stay.withColumn("_n", F.row_number().over(each)).where("_n = 1").drop("_n")
    return stay.select(*docs.columns)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages leave the texts; texts without any stay as they are
    (null ones as empty ones), and every row stays. n_chars follows the text."""
    others = tuple(c for c in docs.columns if c != "text")
    out = substring_dedup.remove_repeated_passages(docs, carry=others)
    new = {c: F.col("carried")[c] for c in others} | {"text": F.col("cleaned")}
    if "n_chars" in others:
        new["n_chars"] = F.when(F.size("removed") > 0, F.length("cleaned").cast(docs.schema["n_chars"].dataType)).otherwise(new["n_chars"])
    return out.select(*[new[c].alias(c) for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with any window of a benchmark item go, the others stay as they are."""
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"), carry=tuple(docs.columns), clean_only=True)
    return found.select("carried.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids in sequences: one row per piece."""
    return packing.pack_documents(docs, packing.vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("decontamination", drop_contaminated),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder and read again."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
