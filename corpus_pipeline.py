"""From a table of documents to ids for training, in five stages.

Each stage gets all rows that the one before kept and gives the columns of documents
again, the last one ids. ``run`` writes every stage's rows to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import bpe, line_dedup, quality, simhash
from tallyframe.llm.queries import mixture, table, vocabulary
from tallyframe.llm.rows import small_batches, store

#: Rows with a lower score go.
LEAST_QUALITY = 0.3

#: No SQL: the classifier is fitted, and fingerprints are hashes that SQL lacks.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    labels = table(spark, sf_dir, "labels").where(~quality.in_fold(F.col("doc_id")))
    scored = quality.score(docs, quality.fit_on(docs, labels))
    return scored.where(F.col("score") >= LEAST_QUALITY).select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that three or more of them share."""
    small_batches(spark)
    made = line_dedup.drop_shared_lines(docs, by_id=True).withColumn("n_chars", F.length("text").cast("long"))
    return made.select(*docs.columns)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    small_batches(spark)
    return simhash.one_of_each(docs, shingle=3, radius=2)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture of sources; a document stands in it once for each epoch."""
    return mixture(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, and the text that they decode to."""
    small_batches(spark)
    ranks, pattern = vocabulary()
    coded = bpe.decode(bpe.encode(docs.select("doc_id", "lang", "source", "text"), ranks, pattern), ranks)
    return coded.select("doc_id", "lang", "source", "n_tokens", "ids", F.col("decoded").cast("string").alias("text"))


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_copies", near_copy_stage),
    ("mixing", mixing_stage),
    ("byte_bpe", encoding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = store(docs, f"stage-{name}")
    return docs
