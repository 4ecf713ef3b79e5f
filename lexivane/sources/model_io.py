"""Vector model files: the public text and binary layouts, and Parquet as the native one."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexivane.operators.model import VectorModel

ROWS = "word_id int, word string, vector array<float>"


def _parse_binary(data: bytes) -> tuple[list[str], np.ndarray]:
    head, _, _ = data.partition(b"\n")
    n, dim = map(int, head.split())
    at, words = len(head) + 1, []
    matrix = np.empty((n, dim), np.float32)
    for i in range(n):
        while data[at : at + 1] == b"\n":
            at += 1
        end = data.index(b" ", at)
        words.append(data[at:end].decode("utf-8", "replace"))
        at = end + 1
        matrix[i] = np.frombuffer(data, "<f4", dim, at)
        at += 4 * dim
    return words, matrix


def read_vectors(spark: SparkSession, path: str, binary: bool = True) -> DataFrame:
    """word_id, word, vector as they stand in a model file."""
    try:
        if binary:
            files = spark.read.format("binaryFile").load(path).select("content")

            def run(frames):
                for pdf in frames:
                    for content in pdf["content"]:
                        words, m = _parse_binary(bytes(content))
                        for a in range(0, len(words), 4096):
                            b = min(a + 4096, len(words))
                            yield pd.DataFrame({"word_id": np.arange(a, b, dtype=np.int32), "word": words[a:b], "vector": list(m[a:b])})

            return files.mapInPandas(run, ROWS)
        lines = spark.read.text(path).withColumn("at", F.monotonically_increasing_id())
        parts = F.filter(F.split("value", r"\s+"), lambda x: x != "")
        rows = lines.filter("at != 0").select(parts.alias("p"), "at").filter(F.size("p") > 1)  # the first line is the header
        # Words are numbered as they stand: the high bits of Spark's ids name a line's partition, and only a count for each is summed over all.
        part = F.shiftright("at", 33)
        before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        counts = lines.filter("at != 0 and value rlike '\\\\S'").groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.min(F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).alias("first"))
        offsets = counts.select("part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("offset"))
        numbered = rows.withColumn("part", part).join(F.broadcast(offsets), "part")  # a row per partition
        word_id = (F.col("offset") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).cast("int")
        return numbered.select(word_id.alias("word_id"), F.element_at("p", 1).alias("word"), F.slice("p", F.lit(2), F.size("p") - 1).cast("array<float>").alias("vector"))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(path) from e
        raise


def read_model(spark: SparkSession, path: str, binary: bool = True) -> VectorModel:
    return VectorModel.from_vectors(read_vectors(spark, path, binary))


def write_text(vectors: DataFrame, path: str, decimals: int = 6) -> None:
    """A header `n dim` and a line per word, in one file."""
    n, dim = vectors.count(), vectors.select(F.size("vector").alias("n")).head().n
    numbers = F.array_join(F.transform("vector", lambda x: F.format_string(f"%.{decimals}f", x.cast("double"))), " ")
    lines = vectors.select(F.col("word_id").cast("long").alias("at"), F.concat_ws(" ", "word", numbers).alias("value"))
    head = vectors.sparkSession.range(1).select(F.lit(-1).cast("long").alias("at"), F.lit(f"{n} {dim}").alias("value"))
    head.unionByName(lines).coalesce(1).sortWithinPartitions("at").select("value").write.mode("overwrite").text(path)


def write_binary(vectors: DataFrame, path: str) -> None:
    """The public binary layout as one file, made by one task: such a file has no parts."""
    n, dim = vectors.count(), vectors.select(F.size("vector").alias("n")).head().n

    def run(frames):
        parts = [f"{n} {dim}\n".encode()]
        for pdf in frames:
            for word, v in zip(pdf["word"], pdf["vector"]):
                parts.append(word.encode() + b" " + np.asarray(v, "<f4").tobytes() + b"\n")
        yield pd.DataFrame({"data": [b"".join(parts)]})

    ordered = vectors.select("word_id", "word", "vector").coalesce(1).sortWithinPartitions("word_id")
    ordered.mapInPandas(run, "data binary").select(F.col("data").cast("string").alias("value")).write.mode("overwrite").option("lineSep", "\n").text(path)


def write_native(model: DataFrame, path: str) -> None:
    """Parquet sorted by word, so that prefix filters skip row groups."""
    model.repartitionByRange("word").sortWithinPartitions("word").write.mode("overwrite").parquet(path)


def write_corpus(corpus: DataFrame, path: str) -> None:
    """One line per row in the order of doc_id."""
    corpus.orderBy("doc_id").select(F.col("line").alias("value")).write.mode("overwrite").text(path)


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """doc_id (the line's `doc_id:` word if it has one, else its order) and line."""
    lines = spark.read.text(path).select(F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))
    own = F.regexp_extract("line", r"^doc_id:([0-9]+)(?: |$)", 1)
    return lines.select(F.when(own != "", own.cast("long")).otherwise(F.col("at")).alias("doc_id"), "line")
