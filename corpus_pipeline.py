"""Cleaning and packing of a corpus: quality, toxicity, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written and read again
for the next. The first three return the columns of the documents, rows in no order; the
last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.llm.common import stored, table
from obslake.llm.minhash import near_duplicates
from obslake.llm.packing import pack_documents
from obslake.llm.quality import score_quality, train_quality
from obslake.llm.queries import byte_vocabulary
from obslake.llm.toxicity import toxic_passages, train_toxicity


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least 0.3."""
    model = train_quality(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, model).where("score >= 0.3").select("doc.*")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5."""
    model = train_toxicity(docs, table(spark, sf_dir, "labels"))
    return toxic_passages(docs, model).where("score < 0.5").select("doc.*")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates; rows without an id stay.

    Of rows repeated whole, one stays.
    """
    found = stored(near_duplicates(docs), "near-duplicates")
    kept = found.where("kept and doc_id is not null").select("doc_id").distinct()
    with_id = docs.where("doc_id is not null").join(kept, "doc_id", "left_semi")
    with_id = with_id.select(*[F.col(f"`{name}`") for name in docs.columns])
    return with_id.dropDuplicates(["doc_id", "text"]).unionAll(docs.where("doc_id is null"))


def pack_all(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens of the documents in sequences."""
    return pack_documents(docs, byte_vocabulary())


STAGES = [
    ("quality", keep_good),
    ("toxicity", drop_toxic),
    ("near_duplicates", keep_one_of_each),
    ("packing", pack_all),
]

#: SQL can express neither the trained scores nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
