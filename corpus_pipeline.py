"""A corpus pipeline of five stages; each reads what the one before has written.

Every stage but the last returns the columns of documents (doc_id, text, lang, source, n_chars), and any
further ones as they are, whatever their names. Empty tables give no rows; texts are read whole; ties and
null values have the results that the stages' operators define.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenframe.llm import minhash, mixing, packing, pii, toxicity
from lumenframe.llm.common import carried, carry, carry_rest, stage, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain doesn't call toxic.

    A null text is judged as an empty one; without labels of both classes none is called toxic; repeated
    rows are judged alike and stay repeated; a null doc_id takes no part in training.
    """
    chain = toxicity.train(docs, table(spark, sf_dir, "labels"))
    toxic = chain.names.index("toxic")
    out = toxicity.score(carry_rest(docs, "text"), chain).where(F.get("_p", F.lit(toxic)) < 0.5)
    return out.select(*carried(docs.columns, text=F.col("text")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the least doc_id.

    Texts without words link with nothing and stay; rows without doc_id are never judged copies; rows that
    repeat doc_id and text are one, those that repeat a kept doc_id with another text stay each.
    """
    kept = minhash.link(docs.select("doc_id", "text")).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    one = carry(docs, "doc_id", "text").join(kept, "doc_id", "left_semi").select("_row", "doc_id", F.xxhash64("text").alias("_h"))
    return one.dropDuplicates(["doc_id", "_h"]).select("_row.*").unionByName(docs.where("doc_id IS NULL"))


def replace_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data and secrets; null and empty texts stay as they are."""
    out = pii.redact(carry_rest(docs, "text"), pii.checked_key(docs))
    return out.select(*carried(docs.columns, text=F.col("text"), n_chars=F.length("text").cast("long")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks; a null source is one of its own."""
    return mixing.emit(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens with their places in sequences; a null text is one token."""
    out = packing.pack_documents(docs.select("doc_id", "text"))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_copies), ("pii", replace_pii), ("mixing", mix_sources), ("packing", pack_sequences)]

#: The classifier, MinHash and the tokenizer have no SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
