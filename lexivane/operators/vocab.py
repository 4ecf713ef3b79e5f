"""Vocabularies: words by count, the sentence end first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexivane.operators.corpus import tokens_of
from lexivane.operators.ranking import numbered

END = "</s>"


def word_counts(corpus: DataFrame, min_count: int = 5) -> DataFrame:
    """word and count of all words that occur often enough: a map-side sum, then one exchange."""
    words = corpus.select(F.explode(tokens_of(F.col("line"))).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("count")).filter(F.col("count") >= min_count)


def build_vocab(corpus: DataFrame, min_count: int = 5) -> DataFrame:
    """word_id, word, count: `</s>` is 0 and counts lines, then by count, ties by first appearance (doc_id, position), then by word. Lines without an id count as before all others."""
    ends = corpus.agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).head()
    # Document and position as one number, which hash aggregation can hold; a pair would have every token sorted. A long holds
    # them where ids span less than 2^31; else a decimal does, which is slower.
    if ends.lo is None or ends.hi - ends.lo < (1 << 31) - 2:
        row = F.coalesce(F.col("doc_id") - F.lit(ends.lo or 0) + 1, F.lit(0)) * F.lit(1 << 31)
    else:
        row = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))).cast("decimal(20,0)") * F.lit(1 << 31).cast("decimal(10,0)")
    words = corpus.select(row.alias("row"), F.posexplode(tokens_of(F.col("line"))).alias("pos", "word"))
    found = words.groupBy("word").agg(F.count("*").alias("count"), F.min(F.col("row") + F.col("pos")).alias("first")).filter((F.col("count") >= min_count) & (F.col("word") != END))
    ranked = numbered(found, [F.desc("count"), F.col("first"), F.col("word")], "word_id").select(F.col("word_id").cast("int").alias("word_id"), "word", "count")
    end = corpus.agg(F.count("*").alias("count")).select(F.lit(0).alias("word_id"), F.lit(END).alias("word"), "count")
    return end.unionByName(ranked)


def save_vocab(vocab: DataFrame, path: str) -> None:
    """`word count` lines in the vocabulary's order."""
    vocab.orderBy("word_id").select(F.concat_ws(" ", "word", F.col("count").cast("string")).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def read_vocab(spark, path: str) -> DataFrame:
    """word_id, word, count of a saved vocabulary; ids by its order: `</s>` first, then by count, ties as they stand."""
    lines = spark.read.text(path).select(F.split("value", " ").alias("p"), F.monotonically_increasing_id().alias("at"))
    rows = lines.filter(F.size("p") >= 2).select(F.element_at("p", 1).alias("word"), F.element_at("p", 2).cast("long").alias("count"), "at")
    ranked = numbered(rows.withColumn("rest", F.col("word") != END), [F.col("rest"), F.desc("count"), F.col("at")], "word_id", 0)
    return ranked.select(F.col("word_id").cast("int").alias("word_id"), "word", "count")
