"""What the operators decide, applied to whole tables of documents.

Each function gives back rows of ``docs`` with all its columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm import exact, simhash, toxicity
from folioscope.llm.common import checkpointed

OWN = ("__id", "__h")


def one_of_each(docs: DataFrame, decided: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs`` that stay; ``decided (id, h, stays)`` has a row per row of ``docs``.

    Rows are known by id and hash of the text, a NULL id being one like any other;
    of a row that is repeated one stays at most.
    """
    leaving = checkpointed(
        decided.groupBy("id", "h")
        .agg(F.count("*").alias("n"), F.max(F.col("stays").cast("long")).alias("stay"))
        .filter("stay < n")
        .select(F.col("id").alias("__left_id"), F.col("h").alias("__left_h"), "stay")
    )
    marked = docs.select(
        F.struct("*").alias("row"), F.col(key).cast("long").alias(OWN[0]), F.xxhash64(text).alias(OWN[1])
    )

    def same(rows: DataFrame):
        return marked[OWN[0]].eqNullSafe(rows["__left_id"]) & (marked[OWN[1]] == rows["__left_h"])

    whole = marked.join(leaving, same(leaving), "left_anti").select("row.*")
    repeated = leaving.filter("stay > 0")
    if repeated.isEmpty():
        return whole
    return whole.union(
        marked.join(repeated, same(repeated), "left_semi").dropDuplicates([*OWN]).select("row.*")
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents whose score is under 0.5; the model learns from the labelled ones."""
    model = toxicity.fit(docs, labels)
    whole = docs.select(F.struct("*").alias("row"), "text")
    return toxicity.score(whole, model).filter("predicted = 0").select("row.*")


def without_copies(docs: DataFrame) -> DataFrame:
    """Of equal texts the row with the largest id."""
    found = exact.exact_duplicates(docs)
    decided = found.select(
        F.col("doc_id").cast("long").alias("id"), F.col("text_hash").alias("h"), F.col("kept").alias("stays")
    )
    return one_of_each(docs, decided)


def without_near_copies(docs: DataFrame, words: int = 3, distance: int = 2) -> DataFrame:
    """Of each group of near copies the row with the smallest id, one without only if none has one.

    If rows share the id, one of them.
    """
    found = checkpointed(simhash.near_duplicates(docs, words, distance))
    own = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash")
    first = found.groupBy("class").agg(F.min(own).alias("first"))
    decided = found.join(first, "class").select(
        F.col("doc_id").alias("id"), F.col("text_hash").alias("h"), own.eqNullSafe(F.col("first")).alias("stays")
    )
    return one_of_each(docs, decided)
