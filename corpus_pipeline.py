"""A training corpus from raw documents, stage by stage.

Each stage takes the documents that its predecessor kept, and returns the columns of
documents; the last returns packed pieces. Its result is written to the shared folder
and read again by the next, so a lost executor costs tasks of one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm import packing, pii, quality, toxicity
from kindred.llm.token_groups import jaccard_components
from kindred.session import materialise


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).where("predicted = 0").select(*docs.columns)


def of_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, model).where("predicted = 1").select(*docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.

    Repeated rows count as copies, but documents without a word are no copies of anything.
    Rows without id cannot be told apart: all stay if one of them does.
    """
    found = jaccard_components(docs)
    kept = (
        found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("doc_id").agg(F.max("n_shingles").alias("most"))
        .select(F.col("doc_id").alias("kept_id"), "most")
    )
    chosen = docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id"]))
    first = chosen.where("most > 0").select(*docs.columns).dropDuplicates(["doc_id", "text"])
    return first.unionByName(chosen.where("most = 0").select(*docs.columns))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact(docs, pii.train(docs), length_col="n_chars")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in windows of 2048."""
    return packing.pack(docs, lists=True)


STAGES = [
    ("toxicity", without_toxic),
    ("quality", of_quality),
    ("jaccard_join", without_copies),
    ("pii", without_personal_data),
    ("packing", packed),
]

#: The classifiers, the labelers and the packing have no SQL form; tests/llm/test_pipeline.py
#: holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents, each on the written result of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
