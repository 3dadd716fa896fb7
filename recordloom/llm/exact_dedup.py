"""Exact duplicates by recipes of content-defined chunks.

A text is cut where its own content says so, into chunks of a thousand characters or more. Its
recipe is the ordered list of its chunks' identifiers. Chunk contents move once, to prove that no two different
chunks share an identifier; after that, documents are compared by their recipes alone, a thousandth of
their size. Texts whose recipe holds an identifier that two chunks do share are compared whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recordloom.llm.texts import stage, text_of

BLANKS = r"[\x20\x09-\x0D]+"
# A chunk ends at the first sentence mark after 1,024 characters, or after 8,192.
CHUNK = r"(?s).{1024,8192}?[.!?。]|.{1024,8192}|.+"

Identify = Callable[[Column], Column]


def chunked(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` with the text without blanks and its chunks."""
    bare = docs.withColumn("_bare", F.regexp_replace(text_of(text_col), BLANKS, ""))
    return bare.withColumn("_chunks", F.regexp_extract_all("_bare", F.lit(CHUNK), F.lit(0)))


def collisions(docs: DataFrame, text_col: str, identify: Identify) -> DataFrame:
    """Identifiers that different chunks share. Equal chunks are merged before they move."""
    chunks = chunked(docs.select(F.col(f"`{text_col}`").alias("text")), "text")
    seen = chunks.select(F.explode("_chunks").alias("chunk")).select(identify(F.col("chunk")).alias("id"), "chunk")
    return seen.distinct().groupBy("id").count().where("count > 1").select("id")


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", identify: Identify = F.xxhash64
) -> DataFrame:
    """Every document with the one of its group that stays.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256`` for every row. Texts are equal when they are the same
    after their blanks are deleted; NULL is empty, and empty texts are equal. The longest original text stays, then the
    smallest id (NULL after all others), then an arbitrary one of the rows that agree in both.
    """
    plain = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    recipe = F.transform("_chunks", lambda chunk: identify(chunk)).alias("recipe")
    listed = chunked(plain, "text").select(
        "doc_id",
        F.length(text_of("text")).alias("length"),
        F.sha2("_bare", 256).alias("text_sha256"),
        recipe,
        F.monotonically_increasing_id().alias("row"),
        F.lit("").alias("whole"),
    )
    recipes = stage(listed, "recipes")
    shared = stage(collisions(plain, "text", identify), "collisions")
    if not shared.isEmpty():
        recipes = stage(spelled_out(plain, recipes, shared, identify), "recipes")
    best = F.min(F.struct(-F.col("length"), F.col("doc_id").isNull(), "doc_id", "row")).alias("best")
    groups = recipes.groupBy("recipe", "whole").agg(F.count("*").alias("group_size"), best)
    return recipes.join(groups, ["recipe", "whole"]).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        "text_sha256",
    )


def spelled_out(plain: DataFrame, recipes: DataFrame, shared: DataFrame, identify: Identify) -> DataFrame:
    """Recipes where texts holding a shared identifier carry their whole text as well."""
    doubtful = stage(
        recipes.select("recipe", F.explode("recipe").alias("id")).join(shared, "id", "left_semi").select("recipe").distinct(),
        "doubtful",
    )
    clear = recipes.join(doubtful, "recipe", "left_anti")
    whole = chunked(plain, "text").select(
        "doc_id",
        F.length(text_of("text")).alias("length"),
        F.sha2("_bare", 256).alias("text_sha256"),
        F.transform("_chunks", lambda chunk: identify(chunk)).alias("recipe"),
        (F.monotonically_increasing_id() + F.lit(1 << 62)).alias("row"),
        F.col("_bare").alias("whole"),
    )
    return clear.unionByName(whole.join(doubtful, "recipe", "left_semi"))


def keep_first(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns: one of each group of equal texts.

    Only the ids that go are joined, so texts stay where they are while that list is small enough to
    broadcast. Rows with a NULL or repeated id are told apart by the digest of their text.
    """
    ids = found.groupBy("doc_id").agg(F.max("kept").alias("any"), F.count("*").alias("rows"))
    ids = stage(ids.where("not any or rows > 1 or doc_id is null"), "ids")
    gone = ids.where("not any and doc_id is not null").select(F.col("doc_id").alias("_gone"))
    left = docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")
    unclear = ids.where("any and rows > 1 or doc_id is null").select(F.col("doc_id").alias("_again"))
    if unclear.isEmpty():
        return left
    same = docs[id_col].eqNullSafe(unclear["_again"])
    stay = found.where("kept").select(F.col("doc_id").alias("_kept"), F.col("text_sha256").alias("_sha256"))
    stay = stage(stay.join(unclear, stay["_kept"].eqNullSafe(unclear["_again"]), "left_semi"), "kept")
    bare = F.sha2(F.regexp_replace(text_of(text_col), BLANKS, ""), 256)
    doubtful = left.join(unclear, same, "left_semi").withColumn("_bare", bare)
    ours = doubtful[id_col].eqNullSafe(stay["_kept"]) & (doubtful["_bare"] == stay["_sha256"])
    turn = F.row_number().over(W.partitionBy(id_col, "_bare").orderBy(F.length(text_of(text_col)).desc()))
    once = doubtful.join(stay, ours, "left_semi").withColumn("_turn", turn).where("_turn = 1").drop("_turn", "_bare")
    return left.join(unclear, same, "left_anti").unionByName(once)
