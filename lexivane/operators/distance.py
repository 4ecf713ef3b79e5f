"""Similarity queries over a vector model."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexivane.functions import text as T
from lexivane.functions import vector as V
from lexivane.operators.pca import scores
from lexivane.operators.terms import Term, parse_terms

DEFAULT_N, FULL_N = 40, 200
#: Fixed value: what an unknown word is answered with.
OOV_MESSAGE = "Output of dictionary word!"


@dataclass
class Result:
    """What a query found. hits has all rows before paging; rows() has the page in order."""

    hits: DataFrame
    order: list
    columns: list[str]
    offset: int = 0
    limit: int = 10
    oov: bool = False
    expanded: str | None = None
    types: dict[str, str] = field(default_factory=dict)
    lead: int = 0

    def rows(self) -> DataFrame:
        df = self.hits.orderBy(*self.order)
        if self.offset:
            df = df.offset(self.offset)
        return (df.limit(self.limit) if self.limit >= 0 else df).select(*self.columns)

    def nhits(self) -> int:
        return self.hits.count()


def prepare_term(term: str, normalizer: str = "auto", is_phrase: bool = False, tokenizer=None) -> str:
    """The query text as the corpus builder would clean it."""
    text = re.sub(r" +\Z", "", re.sub(r"\n+\Z", "", T.normalize_driver(term, normalizer)))
    if tokenizer:
        text = tokenizer(text)
    if not text:
        raise ValueError("an empty term")
    return text.replace(" ", "_") if is_phrase else text


def query_vector(model: DataFrame, terms: list[Term]) -> tuple[np.ndarray | None, list[int], np.ndarray | None]:
    """The unit vector of an expression, the ids of its words, and its first word's vector; None if a word isn't in the model. Looks up the few words only."""
    wanted = sorted({t.word for t in terms})
    found = {r.word: r for r in model.filter(F.col("word").isin(wanted)).select("word_id", "word", "vector").collect()}
    if any(t.word not in found for t in terms):
        return None, [], None
    total = sum(t.sign * np.array(found[t.word].vector, dtype=np.float64) for t in terms)
    n = float(np.linalg.norm(total))
    q = total / n if n else np.full_like(total, np.nan)
    return q, sorted({found[t.word].word_id for t in terms}), np.array(found[terms[0].word].vector, dtype=np.float64)


def with_values(model: DataFrame, query: np.ndarray, exclude: list[int], prefix_filter: str | None = None, stop_filter: str | None = None, sentence_vectors: bool = False) -> DataFrame:
    """word_id, word, vector and value (-2 for NaN) of the words that the filters keep. Filters on words stand below the dot product and reach the scan."""
    df = model.select("word_id", "word", "vector")
    prefix = "doc_id:" if sentence_vectors else prefix_filter
    if prefix:
        df = df.filter(F.col("word").startswith(prefix))
    if exclude:
        df = df.filter(~F.col("word_id").isin(exclude))
    if stop_filter:
        re.compile(stop_filter)
        df = df.filter(~T.full_match(F.col("word"), stop_filter))
    return df.withColumn("value", F.nanvl(V.similarity(F.col("vector"), query), F.lit(-2.0)))


def qualifying(df: DataFrame, threshold: float = -1) -> DataFrame:
    """Values above -1 and, if it is above 0, from the threshold on."""
    return df.filter((F.col("value") > -1) & (F.col("value") >= threshold) if threshold > 0 else F.col("value") > -1)


def candidates(model: DataFrame, query: np.ndarray, exclude: list[int], prefix_filter: str | None = None, stop_filter: str | None = None, threshold: float = -1, sentence_vectors: bool = False) -> DataFrame:
    """All words that qualify, with their values."""
    return qualifying(with_values(model, query, exclude, prefix_filter, stop_filter, sentence_vectors), threshold)


def best_of(df: DataFrame, n_sort: int, threshold: float = -1) -> DataFrame:
    """The n best by value that qualify, ties by word_id; from FULL_N on all of them.

    Whether a value qualifies is asked after the limit: the values that don't are the
    least, and a filter below would have the dot product computed once more for each word.
    """
    if n_sort < 0:
        n_sort = DEFAULT_N
    return qualifying(df.orderBy(F.desc("value"), "word_id").limit(n_sort) if n_sort < FULL_N else df, threshold)


def shown(df: DataFrame, is_phrase: bool = False, output_filter: str | None = None) -> DataFrame:
    """Words as they are shown; words that become alike keep the least value, empty ones go."""
    if not is_phrase and not output_filter:
        return df
    c = F.col("word")
    if is_phrase:
        c = F.translate(c, "_", " ")
    if output_filter:
        re.compile(output_filter)
        c = F.regexp_replace(c, output_filter, "")
    df = df.withColumn("word", c).filter(F.col("word") != "")
    return df.groupBy("word").agg(F.min("value").alias("value"), F.max_by("word_id", F.struct(-F.col("value"), "word_id")).alias("word_id"), F.max_by("vector", F.struct(-F.col("value"), "word_id")).alias("vector"))


def distance(model: DataFrame, term: str, offset: int = 0, limit: int = 10, n_sort: int = DEFAULT_N, threshold: float = -1, normalizer: str = "auto", prefix_filter: str | None = None, stop_filter: str | None = None, output_filter: str | None = None, is_phrase: bool = False, edit_distance: bool = False, pca: int = 0, pca_centered: bool = True, sentence_vectors: bool = False, table: DataFrame | None = None, id_col: str = "doc_id", columns: str | None = None, sortby: str | None = None, expander_mode: bool = False, compat: bool = False, tokenizer=None) -> Result:
    """The words nearest to a term expression.

    Of the modes expander_mode goes before pca, before a document table, before
    edit_distance. An unknown word gives an empty result with oov set.
    """
    text = prepare_term(term, normalizer, is_phrase, tokenizer)
    terms = parse_terms(text, compat)
    query, ids, first = query_vector(model, terms)
    if query is None:
        empty = model.sparkSession.createDataFrame([], "_key string, _value double")
        return Result(empty, [F.desc("_value")], ["_key", "_value"], offset, limit, oov=True, expanded=term if expander_mode else None)
    best = best_of(with_values(model, query, ids, prefix_filter, stop_filter, sentence_vectors), n_sort, threshold)
    if expander_mode:
        words = [r.word for r in shown(best, is_phrase, output_filter).orderBy(F.desc("value"), "word_id").offset(offset).limit(1 if compat else max(1, limit)).collect()]
        return Result(best, [F.desc("value")], ["word", "value"], offset, limit, expanded="(" + " OR ".join(f"({w})" for w in [text, *words]) + ")" if words else text)
    hits = shown(best, is_phrase, output_filter)
    if pca:
        names = [f"_pca_value_{i + 1}" for i in range(pca)]
        own = model.sparkSession.createDataFrame([(-1, terms[0].word, [float(x) for x in first], 1.0)], "word_id int, word string, vector array<double>, value double")
        own = shown(own, is_phrase, output_filter)
        both = own.select("word_id", "word", "vector", "value").unionByName(hits.select("word_id", "word", F.col("vector").cast("array<double>").alias("vector"), "value"))
        made = scores(both, "vector", pca, pca_centered, names)
        made = made.select("word_id", F.col("word").alias("_key"), F.col("value").alias("_value"), *names)
        # The term's own row leads every page; paging is of its neighbours.
        return Result(made, [F.col("word_id") >= 0, F.desc("_value"), "word_id"], ["_key", "_value", *names], offset, limit, lead=1)
    if sentence_vectors and table is not None:
        docs = hits.withColumn("_doc", T.doc_id_of(F.col("word"))).filter("_doc is not null").select("_doc", F.col("value").alias("_score"))
        joined = docs.join(table, F.col("_doc") == table[id_col]).drop("_doc").withColumn("_id", F.col(id_col))
        names = [c.strip() for c in columns.split(",")] if columns else ["_id", "_score"]
        return Result(joined, _sort_keys(sortby or "-_score") + [F.col("_id")], names, offset, limit)
    if edit_distance:
        scored = hits.withColumn("_score", T.edit_distance(F.col("word"), F.lit(terms[0].word), compat)).withColumnRenamed("word", "_key")
        return Result(scored, [F.col("_score"), F.col("value"), F.col("word_id")], ["_key", "_score"], offset, limit)
    named = hits.withColumnRenamed("word", "_key").withColumnRenamed("value", "_value")
    return Result(named, _sort_keys(sortby or "-_value") + [F.col("word_id")], [c.strip() for c in columns.split(",")] if columns else ["_key", "_value"], offset, limit)


def _sort_keys(text: str) -> list:
    return [F.desc(k[1:]) if k.startswith("-") else F.asc(k.lstrip("+")) for k in (x.strip() for x in text.split(",")) if k]


#: Words whose values are held at a time.
SLICE = 2048


def batch_topk(model: DataFrame, queries: DataFrame, k: int = 10, rows: int = 1 << 14, block: int = 1024) -> DataFrame:
    """query_id, word_id, word, value, rank: the k nearest words of each query vector (query_id, vector).

    A matrix product in blocks: words are dealt over the rows of a grid and queries over its
    columns, each cell multiplies about `rows` words with about `block` queries, SLICE words
    at a time, and passes on its k best per query. A task's memory is bounded by the cell's
    vectors and one slice of values, whatever the sizes.
    """
    spark = model.sparkSession
    unit_q = queries.select("query_id", V.unit(F.col("vector")).alias("q")).filter("q is not null")
    across = max(1, -(-queries.count() // block))
    down = max(spark.sparkContext.defaultParallelism // across, -(-model.count() // rows), 1)

    def dealt(df: DataFrame, own: str, n: int, key: str, other: str, m: int) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
        return df.withColumn(own, F.pmod(F.xxhash64(key), F.lit(n)).cast("int")).withColumn(other, every)

    words = dealt(model.select("word_id", "word", "vector"), "i", down, "word_id", "j", across)
    asked = dealt(unit_q, "j", across, "query_id", "i", down)

    def cell(w: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(w) or not len(q):
            return pd.DataFrame({"query_id": np.zeros(0, np.int64), "word_id": np.zeros(0, np.int32), "word": np.zeros(0, object), "value": np.zeros(0)})
        asked_for, x, held = q["query_id"].to_numpy(), np.array(q["q"].tolist()).T, []
        for at in range(0, len(w), SLICE):
            part = w.iloc[at : at + SLICE]
            values = np.array(part["vector"].tolist(), dtype=np.float64) @ x
            values[np.isnan(values)] = -2.0
            # All that are not less than the k-th best of the slice: ties are settled over all slices.
            least = np.partition(values, -k, axis=0)[-k] if k < len(part) else np.full(len(asked_for), -np.inf)
            i, j = np.nonzero(values >= least)
            held.append(pd.DataFrame({"query_id": asked_for[j], "word_id": part["word_id"].to_numpy()[i], "word": part["word"].to_numpy(dtype=object)[i], "value": values[i, j]}))
            if len(held) > 4:
                held = [best(pd.concat(held))]
        return best(pd.concat(held))

    def best(found: pd.DataFrame) -> pd.DataFrame:
        found = found.sort_values(["query_id", "value", "word_id"], ascending=[True, False, True])
        return found[found.groupby("query_id").cumcount() < k]

    found = words.groupBy("i", "j").cogroup(asked.groupBy("i", "j")).applyInPandas(cell, "query_id long, word_id int, word string, value double")
    order = Window.partitionBy("query_id").orderBy(F.desc("value"), "word_id")
    return found.filter("value > -2").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
