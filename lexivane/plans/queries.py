"""Registered queries of the engine's operators, each over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexivane.functions import vector as V
from lexivane.operators import corpus as C
from lexivane.operators.cluster import classes, settled
from lexivane.operators.distance import batch_topk, candidates, distance
from lexivane.operators.expander import expand_query, search
from lexivane.operators.model import VectorModel
from lexivane.operators.seeded import initial_vectors
from lexivane.operators.train import train
from lexivane.operators.vocab import build_vocab, read_vocab, save_vocab, word_counts
from lexivane.sources import model_io
from lexivane.storage import work_dir, written

DIGITS = 6


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- corpora ----------------------------------------------------------------------
def _part_corpus(columns: str, **options):
    options.setdefault("normalizer", "lower")
    return lambda spark, d: C.dump_corpus(table(spark, d, "part"), columns, id_col="p_partkey", **options)


def _doc_corpus(columns: str = "text", **options):
    options.setdefault("normalizer", "lower")
    return lambda spark, d: C.dump_corpus(table(spark, d, "documents"), columns, id_col="doc_id", **options)


def corpus_nfkc(spark, d):
    """The default normalizer, NFKC and lower case."""
    return C.dump_corpus(table(spark, d, "part"), "p_name,p_brand", id_col="p_partkey")


def corpus_segmented(spark, d):
    return C.dump_corpus(table(spark, d, "part"), "p_name/,p_type/", id_col="p_partkey", normalizer="lower")


def corpus_ref_column(spark, d):
    rows = C.resolve_reference(table(spark, d, "supplier"), "s_nationkey", table(spark, d, "nation"), "n_nationkey", "n_name")
    return C.dump_corpus(rows, "s_name,s_nationkey_[nation:]", id_col="s_suppkey", normalizer="lower")


def _order_parts(spark, d):
    items = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda x: x["l_partkey"]).alias("parts"))
    return C.resolve_reference_vector(items, "parts", table(spark, d, "part"), "p_partkey", "p_name", "l_orderkey")


def corpus_ref_vector(spark, d):
    return C.dump_corpus(_order_parts(spark, d), "parts_", id_col="l_orderkey", normalizer="lower")


def corpus_text_vector(spark, d):
    rows = table(spark, d, "part").select("p_partkey", F.split("p_type", " ").alias("types"))
    return C.dump_corpus(rows, "types*2[type:]", id_col="p_partkey", normalizer="lower")


# ---- vocabularies ------------------------------------------------------------------
def _docs_corpus(spark, d):
    return C.dump_corpus(table(spark, d, "documents"), "text$", id_col="doc_id", normalizer="lower")


def _parts_corpus(spark, d):
    return C.dump_corpus(table(spark, d, "part"), "p_name,p_brand", id_col="p_partkey", normalizer="lower")


def vocab_min_count(spark, d):
    return word_counts(_docs_corpus(spark, d), 5)


def vocab_ids(spark, d):
    return build_vocab(_docs_corpus(spark, d), 5)


def vocab_roundtrip(spark, d):
    path = work_dir(spark)
    save_vocab(build_vocab(_parts_corpus(spark, d), 1), path)
    return read_vocab(spark, path)


def _seeded(spark, d):
    return initial_vectors(build_vocab(_parts_corpus(spark, d), 1), 100)


def seeded_init_vectors(spark, d):
    v = _seeded(spark, d)
    return v.select("word_id", "word", F.posexplode("vector").alias("dim", "x")).select("word_id", "word", F.col("dim").cast("long").alias("dim"), F.round(F.col("x").cast("double") * 1000, DIGITS).alias("milli"))


def seeded_distance(spark, d):
    """Corpus, vocabulary, seeded vectors, query: the whole chain without training."""
    model = VectorModel.from_vectors(_seeded(spark, d), 100)
    return _rounded(distance(model.df, "brand#11", normalizer="lower", n_sort=40, limit=40).rows())


# ---- similarity over the embeddings table ----------------------------------------
def model_of(spark, d) -> DataFrame:
    """The embeddings as a model; words are made of label and id."""
    e = table(spark, d, "embeddings")
    word = F.concat(F.lit("c"), F.col("label").cast("string"), F.lit("_"), F.col("vec_id").cast("string"))
    return VectorModel.from_vectors(e.select(F.col("vec_id").cast("int").alias("word_id"), word.alias("word"), F.col("embedding").alias("vector")), 64).df


def doc_model_of(spark, d) -> DataFrame:
    return model_of(spark, d).withColumn("word", F.concat(F.lit("doc_id:"), F.col("word_id").cast("string")))


def _word(model: DataFrame, i: int) -> str:
    """The word of one id: a lookup of one row."""
    return model.filter(F.col("word_id") == i).select("word").head().word


def _rounded(df: DataFrame) -> DataFrame:
    names = {"_key": "word", "_value": "value", "_score": "score", "_id": "id"}
    return df.select(*[F.round(c, DIGITS).alias(names.get(c, c.lstrip("_"))) if kind == "double" else F.col(c).alias(names.get(c, c.lstrip("_"))) for c, kind in df.dtypes])


def _distance(terms, **options):
    def run(spark, d):
        m = model_of(spark, d)
        text = terms(lambda i: _word(m, i)) if callable(terms) else terms
        return _rounded(distance(m, text, normalizer="none", **options).rows())

    return run


def distance_n_sort_full(spark, d):
    m = model_of(spark, d)
    return _rounded(distance(m, _word(m, 7), normalizer="none", n_sort=200, limit=-1).rows())


def distance_nhits(spark, d):
    m = model_of(spark, d)
    found = distance(m, _word(m, 7), normalizer="none", n_sort=200, threshold=0.1)
    return found.hits.agg(F.count("*").alias("nhits"))


def distance_oov(spark, d):
    found = distance(model_of(spark, d), "nosuchword", normalizer="none")
    return _rounded(found.rows())


def _edit(compat: bool):
    def run(spark, d):
        model = VectorModel.from_vectors(_seeded(spark, d), 100)
        return distance(model.df, "brand#11", normalizer="lower", edit_distance=True, compat=compat, limit=-1).rows().select(F.col("_key").alias("word"), F.col("_score").cast("long").alias("score"))

    return run


def sentence_distance(spark, d):
    return _rounded(distance(doc_model_of(spark, d), "doc_id:7", normalizer="none", sentence_vectors=True).rows())


def sentence_distance_table(spark, d):
    return _rounded(distance(doc_model_of(spark, d), "doc_id:7", normalizer="none", sentence_vectors=True, table=table(spark, d, "documents")).rows())


def sentence_distance_table_sortby(spark, d):
    return distance(doc_model_of(spark, d), "doc_id:7", normalizer="none", sentence_vectors=True, table=table(spark, d, "documents"), columns="doc_id,source,lang", sortby="-source").rows()


def batch_distance_topk(spark, d):
    m = model_of(spark, d)
    queries = m.filter("word_id % 100 = 0").select(F.col("word_id").cast("long").alias("query_id"), "vector")
    return batch_topk(m, queries, 5).select("query_id", "word_id", F.round("value", DIGITS).alias("value"), F.col("rank").cast("long").alias("rank"))


def _pca(centered: bool):
    def run(spark, d):
        m = model_of(spark, d)
        found = distance(m, _word(m, 7), normalizer="none", pca=2, pca_centered=centered, limit=-1)
        return found.rows().select(F.col("_key").alias("word"), *[F.round(F.col(c), DIGITS).alias(c.lstrip("_")) for c in ("_value", "_pca_value_1", "_pca_value_2")])

    return run


def vector_normalize(spark, d):
    e = table(spark, d, "embeddings")
    return e.select("vec_id", F.posexplode(V.unit(F.col("embedding"))).alias("dim", "x")).select("vec_id", F.col("dim").cast("long").alias("dim"), F.round("x", DIGITS).alias("x"))


def similarity_scan(spark, d):
    """Every word that qualifies with its cosine: the scan itself."""
    m = model_of(spark, d)
    q = m.filter("word_id = 7").head().vector
    return candidates(m, [float(x) for x in q], [7]).select("word", F.round("value", DIGITS).alias("value"))


def _roundtrip(binary: bool):
    def run(spark, d):
        path = work_dir(spark)
        v = table(spark, d, "embeddings").select(F.col("vec_id").cast("int").alias("word_id"), F.concat(F.lit("w"), "vec_id").alias("word"), F.col("embedding").alias("vector"))
        (model_io.write_binary if binary else model_io.write_text)(v, path)
        back = model_io.read_vectors(spark, path, binary)
        return back.select("word", F.round(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double")), 4).alias("total"), F.size("vector").cast("long").alias("dim"))

    return run


def prefix_scan_native(spark, d):
    """A prefix filter over the native model file, pushed to the scan."""
    path = work_dir(spark)
    model_io.write_native(model_of(spark, d), path)
    return spark.read.parquet(path).filter(F.col("word").startswith("c1_")).select("word_id", "word")


def kmeans_classes(spark, d):
    """Classes are numbered at random, so what is checked is that each word's class is the nearest and every class is one of ten."""
    m = model_of(spark, d)
    found = written(classes(m, 10))
    return settled(m, found, 10).select("word_id", "word", F.col("class").between(0, 9).alias("numbered"), "nearest")


# ---- expansion ---------------------------------------------------------------------
def expander_string(spark, d):
    m = model_of(spark, d)
    text = expand_query(m, _word(m, 7), threshold=0.2)
    return m.sparkSession.range(1).select(F.lit(text).alias("expanded"))


def expanded_search(spark, d):
    m = VectorModel.from_vectors(_seeded(spark, d), 100).df
    rows = search(table(spark, d, "part"), "p_name,p_brand", "brand#11", lambda q: expand_query(m, q, threshold=0.2))
    return rows.select("p_partkey", "p_name", "p_brand")


# ---- training ----------------------------------------------------------------------
def _lines(spark, d):
    return C.dump_corpus(table(spark, d, "part"), "p_name,p_type,p_brand", id_col="p_partkey", normalizer="lower")


def _facts(made, size: int) -> DataFrame:
    """Of each word: id, dimension, whether training has moved it from its seeded vector, and whether all components are finite."""
    start = initial_vectors(made.vocab, size).select("word_id", F.col("vector").alias("start"))
    apart = F.exists(F.arrays_zip("vector", "start"), lambda x: F.abs(x["vector"] - x["start"]) > 1e-7)
    sound = F.forall("vector", lambda x: ~F.isnan(x) & (F.abs(x) < 1e3))
    return made.vectors.join(start, "word_id").select("word_id", "word", F.size("vector").cast("long").alias("dim"), apart.alias("moved"), sound.alias("sound"))


def train_skipgram_hs(spark, d):
    """With whether words of one column, which stand in the same places, are nearer each other than to other words."""
    made = train(_lines(spark, d), min_count=1, sample=0)
    m = made.model.df
    brand = F.col("word").startswith("brand#")
    sums = m.filter("word_id > 0").select(brand.alias("brand"), F.posexplode("vector").alias("j", "x")).groupBy("j").agg(F.avg(F.when(F.col("brand"), F.col("x"))).alias("b"), F.avg(F.when(~F.col("brand"), F.col("x"))).alias("o"))
    # The mean cosine within brands and between brands and others, from the sums of unit vectors.
    alike = sums.agg((F.sum(F.col("b") * F.col("b")) > F.sum(F.col("b") * F.col("o"))).alias("alike"))
    return _facts(made, 100).crossJoin(F.broadcast(alike))


def train_cbow_negative(spark, d):
    made = train(_lines(spark, d), min_count=1, cbow=1, hs=0, negative=5, sample=0)
    return _facts(made, 100).withColumn("loss_falls", F.lit(made.losses[-1] < made.losses[0]))


def train_sentence_vectors(spark, d):
    """Lines of suppliers' nations: a line's own vector is trained with its words."""
    rows = C.resolve_reference(table(spark, d, "supplier"), "s_nationkey", table(spark, d, "nation"), "n_nationkey", "n_name")
    lines = C.dump_corpus(rows, "s_name_,s_nationkey_", id_col="s_suppkey", normalizer="lower", sentence_vectors=True)
    made = train(lines, cbow=1, hs=1, sentence_vectors=True, sample=0)
    return _facts(made, 100).withColumn("loss_falls", F.lit(made.losses[-1] < made.losses[0]))


QUERIES = {
    "corpus_default": _part_corpus("p_name"),
    "corpus_multi_column": _part_corpus("p_name,p_brand,p_type"),
    "corpus_label": _part_corpus("p_brand[brand:],p_name"),
    "corpus_repeat": _part_corpus("p_name,p_brand*3"),
    "corpus_phrase": _part_corpus("p_name_,p_type_"),
    "corpus_phrase_label": _part_corpus("p_name_[name:],p_brand"),
    "corpus_symbol": _doc_corpus("text$"),
    "corpus_alpha": _doc_corpus("text@$,lang"),
    "corpus_input_filter": _doc_corpus("text", input_filter="[0-9]+"),
    "corpus_normalizer_none": _doc_corpus("text", normalizer="none"),
    "corpus_nfkc": corpus_nfkc,
    "corpus_segmented": corpus_segmented,
    "corpus_filter_match": _doc_corpus("text$", filter='text @ "tion"'),
    "corpus_filter_int": _doc_corpus("source,lang", filter="n_chars >= 2000"),
    "corpus_ref_column": corpus_ref_column,
    "corpus_ref_vector": corpus_ref_vector,
    "corpus_text_vector": corpus_text_vector,
    "corpus_sentence_vectors": _doc_corpus("text$", sentence_vectors=True),
    "vocab_min_count": vocab_min_count,
    "vocab_ids": vocab_ids,
    "vocab_roundtrip": vocab_roundtrip,
    "seeded_init_vectors": seeded_init_vectors,
    "seeded_distance": seeded_distance,
    "vector_normalize": vector_normalize,
    "similarity_scan": similarity_scan,
    "distance_default": _distance(lambda w: w(7)),
    "distance_limit": _distance(lambda w: w(7), limit=3),
    "distance_offset": _distance(lambda w: w(7), offset=3, limit=3),
    "distance_n_sort": _distance(lambda w: w(7), n_sort=2),
    "distance_n_sort_full": distance_n_sort_full,
    "distance_nhits": distance_nhits,
    "distance_threshold": _distance(lambda w: w(7), threshold=0.2),
    "distance_prefix": _distance(lambda w: w(7), prefix_filter="c1_"),
    "distance_stop_filter": _distance(lambda w: w(7), stop_filter="c[0-4]_.*"),
    "distance_output_filter": _distance(lambda w: w(7), output_filter="_.*"),
    "distance_is_phrase": _distance(lambda w: w(7).replace("_", " "), is_phrase=True),
    "distance_plus": _distance(lambda w: f"{w(7)} + {w(8)}"),
    "distance_minus": _distance(lambda w: f"{w(7)} - {w(8)}"),
    "distance_chain": _distance(lambda w: f"{w(7)} + {w(8)} - {w(9)}"),
    "distance_oov": distance_oov,
    "distance_edit_distance": _edit(False),
    "distance_edit_distance_compat": _edit(True),
    "sentence_distance": sentence_distance,
    "sentence_distance_table": sentence_distance_table,
    "sentence_distance_table_sortby": sentence_distance_table_sortby,
    "batch_distance_topk": batch_distance_topk,
    "distance_pca": _pca(True),
    "distance_pca_uncentered": _pca(False),
    "expander_string": expander_string,
    "expanded_search": expanded_search,
    "model_text_roundtrip": _roundtrip(False),
    "model_binary_roundtrip": _roundtrip(True),
    "prefix_scan_native": prefix_scan_native,
    "kmeans_classes": kmeans_classes,
    "train_skipgram_hs": train_skipgram_hs,
    "train_cbow_negative": train_cbow_negative,
    "train_sentence_vectors": train_sentence_vectors,
}
