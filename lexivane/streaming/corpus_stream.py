"""Streams: the corpus builder is row-wise, so its plan runs incrementally; word counts are stateful; the words of a stream are scored against a fixed query."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexivane.operators.corpus import dump_corpus, tokens_of
from lexivane.operators.distance import candidates


def stream_corpus(stream: DataFrame, columns: str, **options) -> DataFrame:
    """dump_corpus over a streaming DataFrame; append mode."""
    return dump_corpus(stream, columns, **options)


def stream_word_counts(corpus: DataFrame, time_col: str | None = None, window: str = "10 minutes", late: str = "10 minutes") -> DataFrame:
    """Running word counts of a streaming corpus; by event-time window with a watermark if a time column is given."""
    words = F.explode(tokens_of(F.col("line"))).alias("word")
    if time_col is None:
        return corpus.select(words).groupBy("word").count()
    timed = corpus.withWatermark(time_col, late).select(time_col, words)
    return timed.groupBy(F.window(time_col, window).alias("window"), "word").count()


def stream_similarity(stream: DataFrame, query, threshold: float = -1) -> DataFrame:
    """A stream of word vectors (word_id, word, vector, of unit length) with the value of each that qualifies against a query vector; append mode. A stream has no end, so there is no top list."""
    return candidates(stream, query, [], threshold=threshold)
