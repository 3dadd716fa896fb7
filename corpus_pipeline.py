"""From raw documents to token ids, in five stages.

Every stage reads what the one before kept, from a table in the shared folder, and all but the last return the columns of
``documents``. A lost executor costs a re-read of the last table. Document ids are unique in the input; the mix may
repeat a document, so from there on they are not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm import byte_bpe, exact_dedup, mixing, ngram_join, quality_ranker
from recordloom.llm.queries import readable
from recordloom.llm.texts import prepare, read, stage, word_count

NEAR_WORDS, NEAR_PERCENT = 5, 80


def only_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier accepts; it learns from the labels of documents that are still here.

    A NULL or empty text is scored like any other. Without labels of both kinds every document stays.
    """
    prepare(spark)
    ranker = quality_ranker.fit(docs, read(spark, sf_dir, "labels"))
    return docs.where(quality_ranker.score_column(ranker) >= quality_ranker.THRESHOLD)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the longest, then the one of smallest id. Empty texts are equal."""
    prepare(spark)
    return exact_dedup.keep_first(docs, exact_dedup.exact_groups(docs))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by similar five-word n-grams, the one of smallest id. Texts without words stay."""
    prepare(spark)
    return ngram_join.keep_one(docs, ngram_join.similar_groups(docs, NEAR_WORDS, NEAR_PERCENT))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, as many words in all as came in. Texts without words stay once."""
    prepare(spark)
    size = word_count("text")
    return mixing.repeat(docs, size, readable(size))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, round_trip``: token ids, and whether they decode to the text they came from."""
    prepare(spark)
    return byte_bpe.checked(docs).select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", "round_trip")


STAGES = [
    ("quality", only_good),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("mix", mixed),
    ("encode", encoded),
]

# A fitted model and a tokenizer decide the rows, which SQL cannot express; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
