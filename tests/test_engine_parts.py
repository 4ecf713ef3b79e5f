import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from lexivane.functions import text as T
from lexivane.operators.columnspec import ColumnSpec, parse_columns
from lexivane.operators.corpus import dump_corpus
from lexivane.operators.distance import distance
from lexivane.operators.expander import expand_query, search
from lexivane.operators.model import VectorModel
from lexivane.operators.seeded import states, vector_of
from lexivane.operators.terms import Term, parse_terms
from lexivane.operators.train import huffman, train
from lexivane.operators.vocab import build_vocab, read_vocab, save_vocab
from lexivane.plans.engine import Engine
from lexivane.plans.result import to_json, to_tsv, to_xml
from lexivane.sources import model_io
from lexivane.streaming.corpus_stream import stream_corpus, stream_word_counts


def test_columns():
    assert parse_columns("title_[title:],tag*2,text@$,a/") == [ColumnSpec("title", phrase=True, label="title:"), ColumnSpec("tag", repeat=2), ColumnSpec("text", strip_letters=True, strip_symbols=True), ColumnSpec("a", segment=True)]
    with pytest.raises(ValueError):
        parse_columns("a*1")


def test_terms():
    assert parse_terms("a + b - c") == [Term("a"), Term("b"), Term("c", -1)]
    assert parse_terms("a b - c") == [Term("a"), Term("b"), Term("c", -1)]
    assert parse_terms("a b - c", compat=True) == [Term("a"), Term("b", -1), Term("c")]
    assert [t.word for t in parse_terms("+ a")] == ["+", "a"]


def test_states_have_full_period():
    assert len(set(states().tolist())) == 1 << 16
    unit = lambda i: vector_of(i, 100) / np.linalg.norm(vector_of(i, 100))
    assert float(unit(3) @ unit(4)) == pytest.approx(0.125829, abs=1e-6)
    assert float(unit(3) @ unit(0)) == pytest.approx(-0.100139, abs=1e-6)


@given(st.lists(st.integers(1, 1000), min_size=2, max_size=30))
def test_huffman_is_prefix_free(counts):
    codes = ["".join(map(str, c)) for c in huffman(counts)[0]]
    assert len(set(codes)) == len(codes) and not any(a != b and b.startswith(a) for a in codes for b in codes)


def test_script_runs():
    assert T.script_runs("全文検索データabc12、ね") == "全文検索 データ abc12 、 ね"


def test_empty_and_null(spark):
    df = spark.createDataFrame([(1, None, None), (2, "", []), (3, "x", [None, "y\n"])], "_id long, a string, b array<string>")
    assert [r.line for r in dump_corpus(df, "a,b", id_col="_id").orderBy("doc_id").collect()] == ["", "", "x y"]
    assert [r.line for r in dump_corpus(df, "a,b", id_col="_id", normalizer="lower", sentence_vectors=True).orderBy("doc_id").collect()] == ["doc_id:1 ", "doc_id:2 ", "doc_id:3 x y"]
    with pytest.raises(ValueError):
        dump_corpus(df, "nosuch")


def test_vocab_order(spark):
    corpus = spark.createDataFrame([(1, "b a b"), (2, "c a")], "doc_id long, line string")
    assert [(r.word_id, r.word, r["count"]) for r in build_vocab(corpus, 1).orderBy("word_id").collect()] == [(0, "</s>", 2), (1, "b", 2), (2, "a", 2), (3, "c", 1)]


def test_files(spark, tmp_path):
    v = spark.createDataFrame([(0, "</s>", [0.5, -1.25]), (1, "é", [1e-3, 2.0])], "word_id int, word string, vector array<float>")
    for binary, write in ((True, model_io.write_binary), (False, model_io.write_text)):
        path = f"file://{tmp_path}/m{binary}"
        write(v, path)
        assert [(r.word_id, r.word, [round(x, 6) for x in r.vector]) for r in model_io.read_vectors(spark, path, binary).orderBy("word_id").collect()] == [(0, "</s>", [0.5, -1.25]), (1, "é", [0.001, 2.0])]


def test_models_of_one_dimension(spark, tmp_path):
    v = spark.createDataFrame([(0, "12", [0.5]), (1, "b", [-2.0]), (2, "c", [0.0])], "word_id int, word string, vector array<float>")
    for binary, write in ((True, model_io.write_binary), (False, model_io.write_text)):
        path = f"file://{tmp_path}/one{binary}"
        write(v, path)
        assert [tuple(r) for r in model_io.read_vectors(spark, path, binary).orderBy("word_id").collect()] == [(0, "12", [0.5]), (1, "b", [-2.0]), (2, "c", [0.0])]


def test_text_models_in_many_parts(spark, tmp_path):
    """Words keep their order however many tasks read the file."""
    n = 5000
    v = spark.range(n).selectExpr("CAST(id AS INT) AS word_id", "concat('w', id) AS word", "array(CAST(id AS FLOAT), CAST(1 AS FLOAT)) AS vector")
    path = f"file://{tmp_path}/parts"
    model_io.write_text(v, path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        back = model_io.read_vectors(spark, path, False)
        assert back.rdd.getNumPartitions() > 3
        assert [(r.word_id, r.word, r.vector[0]) for r in back.orderBy("word_id").collect()] == [(i, f"w{i}", float(i)) for i in range(n)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_saved_vocabularies(spark, tmp_path):
    corpus = spark.createDataFrame([(None, "b a b"), (None, "c a"), (5, "d"), (5, "e")], "doc_id long, line string")
    vocab = build_vocab(corpus, 1)
    want = [(r.word_id, r.word, r["count"]) for r in vocab.orderBy("word_id").collect()]
    assert [w[1] for w in want][:3] == ["</s>", "b", "a"] or [w[1] for w in want][:3] == ["</s>", "a", "b"]
    assert sorted(w[0] for w in want) == list(range(6))
    save_vocab(vocab, f"file://{tmp_path}/vocab")
    assert [(r.word_id, r.word, r["count"]) for r in read_vocab(spark, f"file://{tmp_path}/vocab").orderBy("word_id").collect()] == want


@pytest.mark.parametrize("low,high", [(0, 7), (-(1 << 62), 1 << 62)])
def test_vocab_order_of_any_ids(spark, low, high):
    """Ids whose span a long can hold beside positions, and others."""
    corpus = spark.createDataFrame([(high, "z a"), (low, "y b z a"), (None, "x")], "doc_id long, line string")
    got = [r.word for r in build_vocab(corpus, 1).orderBy("word_id").collect()]
    assert got == ["</s>", "z", "a", "x", "y", "b"]


def test_lines_stay_rows(spark):
    """Lines without ids, or of one id, are lines of their own when they are trained on."""
    from lexivane.operators.train import subsampled

    corpus = spark.createDataFrame([(None, "a b"), (None, "c"), (7, "a d"), (7, None), (7, "c c nosuch")], "doc_id long, line string")
    vocab = build_vocab(corpus.filter("line != 'c c nosuch' or line is null"), 1).orderBy("word_id").collect()
    got = sorted(r.words for r in subsampled(corpus, vocab, 0).collect())
    assert got == [[], ["a", "b"], ["a", "d"], ["c"], ["c", "c"]]
    many = spark.createDataFrame([(i, "often " * 50) for i in range(40)] + [(99, "seldom word")], "doc_id long, line string")
    vocab = build_vocab(many, 1).orderBy("word_id").collect()
    kept = [w for r in subsampled(many, vocab, 1e-2).collect() for w in r.words]
    assert kept.count("seldom") == 1 and 0.05 < kept.count("often") / 2000 < 0.25


def test_windows_of_lines():
    """Every pair of a window of full reach, none across lines, the document's word in each window."""
    from lexivane.operators.train import windows

    class Full:
        def integers(self, low, high, size):
            return np.zeros(size, np.int64)

    lines = [np.array([9, 1, 2, 3]), np.array([4]), np.array([], np.int64), np.array([9, 5])]
    words, place, context = windows(lines, 2, Full())
    got = sorted(zip(place.tolist(), context.tolist()))
    want, at = [], 0
    for line in lines:
        want += [(at + i, int(line[j])) for i in range(len(line)) for j in range(max(0, i - 2), min(len(line), i + 3)) if i != j]
        at += len(line)
    assert words.tolist() == [9, 1, 2, 3, 4, 9, 5] and got == sorted(want)
    far = windows([np.array([9, 1, 2, 3, 4])], 1, Full(), frozenset([9]))
    assert sorted(zip(far[1].tolist(), far[2].tolist())) == sorted([(0, 1), (1, 9), (1, 2), (2, 1), (2, 3), (2, 9), (3, 2), (3, 4), (3, 9), (4, 3), (4, 9)])


def test_threads_are_partitions(spark):
    from lexivane.operators import train as T2

    corpus = spark.createDataFrame([(i, f"a{i % 7} b{i % 5} c") for i in range(400)], "doc_id long, line string")
    old, T2.LEAST_WORDS = T2.LEAST_WORDS, 100
    try:
        one, four = (train(corpus, size=8, iter=2, cbow=1, hs=0, negative=3, min_count=1, sample=0, threads=n) for n in (1, 4))
        again = train(corpus, size=8, iter=2, cbow=1, hs=0, negative=3, min_count=1, sample=0, threads=4)
    finally:
        T2.LEAST_WORDS = old
    vectors = lambda m: {r.word: list(r.vector) for r in m.vectors.collect()}
    assert vectors(four) == vectors(again) != vectors(one) and four.losses == again.losses


def test_similarity_of_a_stream(spark, tmp_path):
    from lexivane.streaming.corpus_stream import stream_similarity

    spark.createDataFrame([(1, "a", [1.0, 0.0]), (2, "b", [0.6, 0.8]), (3, "c", [-1.0, 0.0])], "word_id int, word string, vector array<float>").coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("word_id int, word string, vector array<float>").parquet(f"{tmp_path}/in")
    q = stream_similarity(stream, [1.0, 0.0], 0.5).writeStream.format("memory").queryName("near").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    assert {r.word: round(r.value, 6) for r in spark.table("near").collect()} == {"a": 1.0, "b": 0.6}


def test_work_tables_need_a_shared_folder():
    """Only a session of one process may have a folder of its own."""
    from types import SimpleNamespace

    from lexivane.storage import shared_dir

    session = lambda master, folder: SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: folder), sparkContext=SimpleNamespace(master=master))
    assert shared_dir(session("yarn", "hdfs://x/shared/")) == "hdfs://x/shared"
    with pytest.raises(ValueError):
        shared_dir(session("spark://host:7077", None))


def test_zero_and_nan_vectors_are_near_nothing(spark):
    m = VectorModel.from_vectors(spark.createDataFrame([(0, "a", [1.0, 0.0]), (1, "z", [0.0, 0.0]), (2, "b", [1.0, 1.0]), (3, "n", [float("nan"), 1.0])], "word_id int, word string, vector array<float>"))
    assert [r[0] for r in distance(m.df, "a").rows().collect()] == ["b"]


def test_search(spark):
    df = spark.createDataFrame([(1, ["Sql"]), (2, ["Other"]), (3, ["postsql"])], "id long, tags array<string>")
    assert [r.id for r in search(df, "tags", "sql", lambda q: f"(({q}) OR (postsql))").collect()] == [1, 3]
    m = spark.createDataFrame([(0, "a", [1.0, 0.0]), (1, "b", [1.0, 0.1])], "word_id int, word string, vector array<float>")
    assert expand_query(m, "nosuch") == "nosuch" and expand_query(VectorModel.from_vectors(m).df, "a") == "((a) OR (b))"


@pytest.mark.parametrize("options", [{"mode": "ml"}, {"cbow": 1, "hs": 0, "negative": 4, "mode": "own", "alpha": 0.5, "window": 2}, {"cbow": 0, "negative": 3, "mode": "own", "alpha": 0.2, "window": 2}])
def test_trained_vectors(spark, options):
    lines = [(i, " ".join(["red apple fruit green", "blue sky cloud grey"][i % 2].split() * 6)) for i in range(60)]
    corpus = spark.createDataFrame(lines, "doc_id long, line string")
    m = train(corpus, size=16, iter=12, min_count=1, sample=0, **options).model.df
    got = [r[0] for r in distance(m, "apple", normalizer="none", limit=3).rows().collect()]
    assert m.count() == 9 and {"red", "fruit", "green"} & set(got[:2])


def test_engine(spark, tmp_path):
    rows = spark.createDataFrame([(1, "AlphaText", "Lib", ["Gamma", "Delta"]), (2, "Database", "Server", ["Sql", "Postsql"])], "_id long, title string, tag string, tags array<string>")
    with Engine(spark, f"file://{tmp_path}", {"Entries": rows}, train_mode="init") as e:
        assert e.run("dump_to_train_file Entries title,tag,tags") is True
        assert e.run("word2vec_train --min_count 1 --save_vocab_file vocab") is True
        assert e.run("word2vec_load") is True
        r = e.run('word2vec_distance "Gamma" --limit 3')
        assert r.nhits() == 8 and r.rows().head()[0] == "delta"
        assert to_json(r).startswith('[[[8], [["_key", "ShortText"], ["_value", "Float"]], ["delta", 0.1258')
        assert to_tsv(r).splitlines()[0] == "8" and '<RESULTSET NHITS="8">' in to_xml(r)
        assert "Output of dictionary word!" in to_json(e.run("word2vec_distance nosuch"))
        assert to_json(e.run("word2vec_distance Gamma --pca 2 --offset 1 --limit 2")).count("[") == 11
        assert e.run("word2vec_load --file_path nosuch.bin") is False
        assert e.run("word2vec_unload") is True
        with pytest.raises(ValueError):
            e.run("nosuch")


def test_streaming(spark, tmp_path):
    spark.createDataFrame([(1, "A b"), (2, "b C")], "id long, t string").coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("id long, t string").parquet(f"{tmp_path}/in")
    q = stream_word_counts(stream_corpus(stream, "t", id_col="id", normalizer="lower")).writeStream.format("memory").queryName("counts").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert {r.word: r["count"] for r in spark.table("counts").collect()} == {"a": 1, "b": 2, "c": 1}


def test_entry_point():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and len(e.queries()) > 50


def test_batch_topk_in_any_blocks(spark):
    from lexivane.operators.distance import batch_topk

    rng = np.random.default_rng(1)
    v = rng.normal(size=(200, 8))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    m = VectorModel.from_vectors(spark.createDataFrame([(i, f"w{i}", [float(y) for y in x]) for i, x in enumerate(v)], "word_id int, word string, vector array<float>"), 8).df.persist()
    q = m.filter("word_id % 7 = 0").selectExpr("cast(word_id as long) as query_id", "vector")
    want = {(i, j) for i in range(0, 200, 7) for j in np.argsort(-(v @ v[i]), kind="stable")[:3]}
    for options in ({}, {"rows": 30, "block": 5}):
        assert {(r.query_id, r.word_id) for r in batch_topk(m, q, 3, **options).collect()} == want
    assert batch_topk(m, q.limit(0), 3).count() == 0 and batch_topk(m.limit(0), q, 3).count() == 0


def test_a_long_line_does_not_turn_training_off(spark):
    from lexivane.operators.seeded import initial_vectors
    from lexivane.operators.train import train

    rows = [(0, " ".join(f"w{i % 50}" for i in range(3000)))] + [(k, " ".join(f"w{(k + i) % 50}" for i in range(20))) for k in range(1, 600)]
    made = train(spark.createDataFrame(rows, "doc_id long, line string"), size=4, iter=1, cbow=1, hs=0, negative=2, min_count=1, sample=0)
    start = {r.word: list(r.vector) for r in initial_vectors(made.vocab, 4).collect()}
    assert any(list(r.vector) != start[r.word] for r in made.vectors.collect())


def test_training_does_not_follow_the_order_of_lines(spark):
    """The loss of an iteration is below that of the one before, where lines come in stretches of copies."""
    rng = np.random.default_rng(1)
    words = [[f"{kind}{i}" for i in range(n)] for kind, n in (("a", 8), ("b", 8), ("c", 6), ("d", 25))]
    rows = [(i, " ".join(w[j] for w, j in zip(words, rng.integers(0, [len(w) for w in words])))) for i in range(5_000)]
    rows = [(i + 10_000 * copy, line) for i, line in rows for copy in range(2)]
    corpus = spark.createDataFrame(rows, "doc_id long, line string").coalesce(1)
    losses = train(corpus, size=20, cbow=1, hs=0, negative=5, min_count=1, sample=0).losses
    assert losses == sorted(losses, reverse=True) and losses[-1] < losses[0]


def test_copies_without_ids_are_trained_apart(spark):
    from lexivane.operators.train import subsampled

    corpus = spark.createDataFrame([(None, "a b")] * 50, "doc_id long, line string")
    turns = [r.turn for r in subsampled(corpus, build_vocab(corpus, 1).collect(), 0).collect()]
    assert len(set(turns)) == 50
    assert sorted(turns) == sorted(r.turn for r in subsampled(corpus, build_vocab(corpus, 1).collect(), 0).collect())


def test_sentence_vectors_of_many_lines(spark):
    """As above where each line has words of its own: the loss falls in each iteration."""
    rng = np.random.default_rng(1)
    rows = [(i, f"doc_id:{i} own{i} group{j}") for i, j in enumerate(rng.integers(0, 25, 3_000))]
    losses = train(spark.createDataFrame(rows, "doc_id long, line string"), size=50, cbow=1, hs=1, sentence_vectors=True, sample=0, partitions=3).losses
    assert losses == sorted(losses, reverse=True) and losses[-1] < losses[0]


def test_weights_stay_off_the_driver(spark):
    """The driver's Python never holds as much as the weights of all words."""
    import tracemalloc

    corpus = spark.createDataFrame([(i, f"doc_id:{i} own{i} group{i % 25}") for i in range(3_000)], "doc_id long, line string")
    tracemalloc.start()
    try:
        made = train(corpus, size=800, iter=1, cbow=1, hs=1, sentence_vectors=True, sample=0, partitions=3)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert made.vectors.count() == 6_026 and most < 6_026 * 800 * 8


@pytest.mark.parametrize("options", [{"hs": 1}, {"hs": 0, "negative": 3}, {"hs": 1, "negative": 2, "sentence_vectors": True}])
def test_batches_do_not_decide_what_is_trained(spark, options):
    """Rows of weights and lines come in batches of any size."""
    corpus = spark.createDataFrame([(i, f"doc_id:{i} a{i % 7} b{i % 5} c") for i in range(60)], "doc_id long, line string")
    key, got = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    old = spark.conf.get(key)
    for n in (10_000, 7):
        spark.conf.set(key, n)
        try:
            made = train(corpus, size=8, iter=2, cbow=1, min_count=1, sample=0, partitions=3, **options)
        finally:
            spark.conf.set(key, old)
        got.append(({r.word: list(r.vector) for r in made.vectors.collect()}, made.losses))
    assert got[0] == got[1]


def test_classes_are_at_rest(spark):
    """No word is nearer to the mean of another class than to its own, however slowly k-means gets there."""
    from lexivane.operators.cluster import classes, settled

    x = np.random.default_rng(1).normal(size=(4_000, 24))
    rows = [(i, f"w{i}", [float(a) for a in v]) for i, v in enumerate(x)]
    model = VectorModel.from_vectors(spark.createDataFrame(rows, "word_id int, word string, vector array<float>"), 24).df
    found = settled(model, classes(model, 10), 10)
    assert found.filter("class between 0 and 9").count() == 4_000
    assert found.filter("not nearest").count() == 0
    assert classes(model, 10, rounds=2).count() == 4_000


def test_rounds_go_on_from_any_centres(spark, monkeypatch):
    """The exact rounds get to rest alone, from where Spark ML's have stopped after one; vectors alike and fewer than classes."""
    from lexivane.operators import cluster

    monkeypatch.setattr(cluster, "MOST_ROUNDS", 1)
    x = np.random.default_rng(2).normal(size=(300, 8))
    rows = [(i, f"w{i}", [float(a) for a in v]) for i, v in enumerate(x)]
    model = VectorModel.from_vectors(spark.createDataFrame(rows, "word_id int, word string, vector array<float>"), 8).df
    assert cluster.settled(model, cluster.classes(model, 4), 4).filter("not nearest").count() == 0
    few = VectorModel.from_vectors(spark.createDataFrame([(i, f"w{i}", [1.0, float(i % 2)]) for i in range(9)], "word_id int, word string, vector array<float>"), 2).df
    assert cluster.settled(few, cluster.classes(few, 5), 5).filter("nearest").count() == 9
