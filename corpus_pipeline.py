"""From raw documents to packed training sequences, in five stages.

Each stage takes what its predecessor kept and is written before the next one reads it.
A stage changes texts or drops documents; ``n_chars`` follows the text. The last stage
returns the places of all documents in the sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.llm import decontaminate, minhash, packing, repeats
from martwright.llm.common import stored
from martwright.llm.quality_rules import quality_rules

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SEQUENCE_TOKENS = 4096
END_ID = 1

#: SQL cannot express the token ids of the last stage; a test follows the stages by brute force.
ORACLE_SQL = None


def _documents(docs: DataFrame) -> DataFrame:
    """The columns of documents, with the length of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def clean_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without their failing lines."""
    judged = quality_rules(docs.select(*COLUMNS)).where("kept")
    return _documents(judged.withColumn("text", F.col("cleaned_text")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id.

    Repeated rows of a kept id and text stay once; different texts under one id are
    different documents. Rows with a null id stay.
    """
    judged = minhash.judged(docs).where("kept and doc_id is not null")
    kept = stored(judged.select("doc_id", "set_key").distinct(), "kept")
    with_id = docs.where("doc_id is not null").join(kept.select("doc_id").distinct(), "doc_id", "left_semi")
    repeated = with_id.groupBy("doc_id").count().where("count > 1").select("doc_id")
    once = with_id.join(repeated, "doc_id", "left_anti")
    keyed = minhash.with_set_keys(with_id.join(repeated, "doc_id", "left_semi").select(*COLUMNS), name="own_key")
    own = (keyed["doc_id"] == kept["doc_id"]) & keyed["own_key"].eqNullSafe(kept["set_key"])
    # Texts of one id and set count as one, texts without words if they are equal.
    first = (
        keyed.join(kept, own, "left_semi")
        .groupBy("doc_id", F.coalesce("own_key", "text"))
        .agg(F.min(F.struct(*COLUMNS)).alias("first"))
        .select("first.*")
    )
    nameless = docs.where("doc_id is null")
    return once.unionByName(first).unionByName(nameless).select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that stand in one with a smaller id."""
    return _documents(repeats.without_repeats(docs.select(*COLUMNS)))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.without_leaks(docs.select(*COLUMNS), items)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the documents' pieces in sequences of 4096 tokens, with the token ids."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.best_fit(packing.token_pieces(docs, path, END_ID, SEQUENCE_TOKENS), SEQUENCE_TOKENS)


STAGES = [
    ("quality rules", clean_lines),
    ("near-duplicates", drop_near_duplicates),
    ("repeated passages", cut_repeats),
    ("benchmark leaks", drop_leaks),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
