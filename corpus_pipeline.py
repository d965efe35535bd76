"""A corpus from raw documents: toxic ones go, near copies go, benchmark passages go, the rest is packed.

``run`` applies the stages in order; each is written to the shared folder and read again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from telemetry_lake.llm import decontamination, near_copies, packing, toxicity
from telemetry_lake.llm.queries import ready
from telemetry_lake.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones among them, does not reject.

    A null or empty text has the score of a text without known features; repeated rows and null ids go the way of their
    text. Without labelled rows of both kinds no document goes. An empty table stays empty; all columns stay.
    """
    labels = ready(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.train(docs, labels))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies: the one of the least id; of rows with one id and text one stays.

    Texts without words are copies only where they are equal (null and empty ones alike). Of several classes that share an
    id (null included) each keeps its own row. An empty table stays empty; all columns stay, whatever their names.
    """
    return near_copies.without_copies(ready(spark), docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark.

    A null or empty text has none. Repeated rows go or stay together; an empty table or benchmark changes nothing; all
    columns stay.
    """
    benchmark = ready(spark).read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.decontaminated(docs, benchmark)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequences.

    A null or empty text is one piece of the end token alone. Rows are packed each, repeated ones and those with null ids
    too. An empty table gives no piece. Of the columns the id is carried, so other names are free.
    """
    import public_tokenizers

    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(ready(spark), docs, tokenizer, end_id=0, capacity=2048)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

# The classifier, the signatures and the tokens have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = ready(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
