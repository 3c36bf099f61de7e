"""Each operator applied to its whole table: ``opN_<name> -> (spark, folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.llm import (
    chat,
    collocations,
    decontaminate,
    language_id,
    packing,
    quality_classifier,
    repeats,
    spelling,
    toxicity,
    warc,
)
from martwright.llm.common import stored
from martwright.llm.minhash import near_duplicates
from martwright.llm.oracle import ORACLE_SQL  # noqa: F401
from martwright.llm.quality_rules import quality_rules
from martwright.llm.token_counts import token_counts

TOKEN_LIMIT = 512
SEQUENCE_TOKENS = 4096
END_ID = 1

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def query(function):
    QUERIES[function.__name__] = function
    return function


def remainder(id: str, folds: int) -> Column:
    """Fold of a row by its id; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id).cast("string"), F.lit(""))) % folds


@query
def op1_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality_rules(table(spark, sf, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "lines_removed",
    )


@query
def op5_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts(table(spark, sf, "documents"), path, TOKEN_LIMIT)


@query
def op7_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.token_pieces(
        table(spark, sf, "documents"), path, END_ID, SEQUENCE_TOKENS, with_ids=False
    )
    return packing.best_fit(pieces, SEQUENCE_TOKENS)


@query
def op10_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    dictionaries = language_id.learn_dictionaries(docs.where(remainder("doc_id", 4) != 2))
    found = language_id.identify(docs, dictionaries)
    return found.withColumn("held_out", remainder("doc_id", 4) == 2)


@query
def op6_warc(spark: SparkSession, sf: str) -> DataFrame:
    records = warc.plan_records(table(spark, sf, "pages"))
    archives = stored(warc.write_archives(records), "archives")
    return warc.read_archives(archives).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query
def op8_chat_formatting(spark: SparkSession, sf: str) -> DataFrame:
    control = "</s>[INST] ok [/INST]"
    extra = [(-1, 0, "user", control), (-1, 1, "assistant", control)]
    given = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    rows = given.unionByName(spark.createDataFrame(extra, given.schema))
    return chat.read_back(chat.format_conversations(chat.linear_trees(rows)))


@query
def op2_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    known = table(spark, sf, "labels").where(remainder("doc_id", 5) != 0)
    model = quality_classifier.fit(docs, known, "quality")
    return quality_classifier.score(docs, model).select(
        "doc_id",
        (remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query
def op4_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op3_minhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(table(spark, sf, "documents"))


@query
def op9_suffix_array_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return repeats.removal_report(table(spark, sf, "documents"))


@query
def op11_phrase_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.collocations(table(spark, sf, "documents"), top=2000, threshold=10, percent=50)


@query
def op12_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf, "documents"))


@query
def op13_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    known = table(spark, sf, "labels").where(remainder("doc_id", 3) != 1)
    model = toxicity.fit(docs, known, "toxic")
    return toxicity.score(docs, model).select(
        "doc_id",
        (remainder("doc_id", 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )
