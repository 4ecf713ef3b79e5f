"""Whole cases by commands: published expectations on rows of our own. Similarities of seeded vectors depend on the order of the vocabulary alone."""

import pytest

from lexivane.operators.corpus import dump_corpus, resolve_reference, resolve_reference_vector
from lexivane.operators.distance import distance
from lexivane.operators.expander import expand_query, search
from lexivane.operators.train import train
from lexivane.plans.engine import Engine
from lexivane.plans.result import table_of

#: Published similarities of words whose ids differ by one, and of other pairs that the cases have.
NEXT, NEXT_ROUNDED, FIRST_PAIR, LAST_TO_END = 0.12582902610302, 0.125836715102196, 0.18340303003788, 0.117504417896271
#: Published principal scores of the third word among eight, and of the similarity in the segmented case.
PCA_FIRST, SEGMENTED = (0.0166809968650341, 0.60534143447876), 0.116262093186378

SCHEMA = "_id long, title string, tag string, tags array<string>"
ONE = ("NightTrain", "Rail", ["Coach", "Sleeper"])
TWO = ("Harbour", "Port", ["Crane", "Pilotboat"])


def table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i + 1, *r) for i, r in enumerate(rows)], schema)


@pytest.fixture
def engine(spark, tmp_path):
    with Engine(spark, f"file://{tmp_path}", {"Rows": table(spark, [ONE, TWO]), "Many": table(spark, [ONE] * 5 + [TWO])}, train_mode="init") as e:
        yield e


def page(e, line):
    n, _, rows = table_of(e.run(line))
    return n, rows


def near(row, word, value):
    assert row[0] == word and row[1] == pytest.approx(value, abs=2e-6)


@pytest.mark.parametrize("columns,term,word,value", [
    ("tag[tag:],tags,title", "tag:rail", "coach", FIRST_PAIR),  # a label of a reference column
    ("tags[tag:],title,tag", "tag:coach", "tag:sleeper", FIRST_PAIR),  # of a vector of references or texts
    ("title_[title:],tag_,tags_", "port", "</s>", LAST_TO_END),  # phrases with a label
])
def test_labels(engine, columns, term, word, value):
    engine.run(f"dump_to_train_file Rows {columns}")
    engine.run("word2vec_train --min_count 1")
    n, rows = page(engine, f"word2vec_distance {term}")
    assert n == 8
    near(rows[0], word, value)


def test_labels_of_references(spark, engine, tmp_path):
    """References are resolved by joins before the corpus is made."""
    tags = spark.createDataFrame([(i, k) for i, k in enumerate(["Rail", "Port", "Coach", "Sleeper", "Crane", "Pilotboat"])], "id long, key string")
    raw = spark.createDataFrame([(1, "NightTrain", 0, [2, 3]), (2, "Harbour", 1, [4, 5])], "_id long, title string, tag long, tags array<long>")
    engine.tables["Raw"] = resolve_reference_vector(resolve_reference(raw, "tag", tags, "id", "key"), "tags", tags, "id", "key", "_id")
    for columns, term, word in (("tag[tag:],tags,title", "tag:rail", "coach"), ("tags[tag:],title,tag", "tag:coach", "tag:sleeper")):
        engine.run(f"dump_to_train_file Raw {columns}")
        engine.run("word2vec_train --min_count 1")
        engine.run("word2vec_load")
        n, rows = page(engine, f"word2vec_distance {term}")
        assert n == 8
        near(rows[0], word, FIRST_PAIR)


def test_several_models(engine):
    engine.run('dump_to_train_file Many title,tags --train_file "db/a.txt"'.replace("db/", f"{engine.workspace}/db/"))
    engine.run('dump_to_train_file Many title,tag --train_file "db/b.txt"'.replace("db/", f"{engine.workspace}/db/"))
    for x in "ab":
        engine.run(f"word2vec_train --min_count 1 --train_file {engine.workspace}/db/{x}.txt --output_file {engine.workspace}/db/{x}.bin")
    first = page(engine, f"word2vec_distance Coach --file_path {engine.workspace}/db/a.bin")
    assert first[0] == 6 and page(engine, f"word2vec_distance Rail --file_path {engine.workspace}/db/b.bin")[0] == 4
    assert page(engine, f"word2vec_distance Coach --file_path {engine.workspace}/db/a.bin") == first
    assert page(engine, f"word2vec_distance Rail --file_path {engine.workspace}/db/a.bin")[0] == 0


def test_words_of_one_letter(spark, engine):
    engine.tables["Short"] = table(spark, [("a",), ("a1",), ("a2",)], "_id long, title string")
    engine.run("dump_to_train_file Short title")
    engine.run("word2vec_train --min_count 1")
    n, rows = page(engine, "word2vec_distance a1")
    assert n == 3
    near(rows[0], "a", FIRST_PAIR)


def test_segmented_by_a_given_tokenizer(spark, tmp_path):
    """Shape of the case: one word three times, seven once before the term, which is the eighth."""
    words = ["天気", "予報", "週間", "旅行", "で", "foo", "データ"]

    def cut(text):
        for w in words:
            text = text.replace(w, f" {w} ")
        return " ".join(text.split())

    rows = table(spark, [("天気予報", "週間予報", ["旅行で予報", "Foo"]), ("データ", "Port", ["Crane", "Pilotboat"])])
    with Engine(spark, f"file://{tmp_path}", {"Rows": rows}, tokenizer=cut, train_mode="init") as e:
        e.run("dump_to_train_file Rows title/,tag/,tags/")
        e.run("word2vec_train --min_count 1")
        n, got = page(e, "word2vec_distance Port")
        assert n == 10
        near(got[0], "foo", SEGMENTED)
        # The option on a query has its term segmented too.
        assert page(e, "word2vec_distance 天気 --mecab_option -Owakati")[0] == 10


@pytest.mark.parametrize("options,shown", [("--pca 2", 9), ("--pca 2 --pca_centered 1", 9), ("--pca 2 --offset 1 --limit 2", 3), ("--pca 2 --n_sort 201", 9)])
def test_pca_pages(engine, options, shown):
    engine.run("dump_to_train_file Rows title,tag,tags")
    engine.run("word2vec_train --min_count 1")
    n, rows = page(engine, f"word2vec_distance Coach {options}")
    assert n == 9 and len(rows) == shown and rows[0][:2] == ["coach", 1.0]
    # All hits are scored with their own vectors on the path of 200 and more too.
    assert [abs(x) for x in rows[0][2:]] == pytest.approx(PCA_FIRST, abs=1e-4)


def test_a_model_stays_loaded(engine):
    engine.run("dump_to_train_file Rows title,tag,tags")
    engine.run("word2vec_train --min_count 1")
    near(page(engine, "word2vec_distance Coach")[1][0], "sleeper", NEXT)
    near(page(engine, "word2vec_distance Sleeper")[1][0], "coach", NEXT)
    engine.run("dump_to_train_file Many title,tag")
    engine.run("word2vec_train --min_count 1")
    assert page(engine, "word2vec_distance Coach")[0] == 8  # until it is loaded anew
    assert engine.run("word2vec_load") is True and page(engine, "word2vec_distance Coach")[0] == 0


@pytest.mark.parametrize("binary,value", [("1", NEXT), ("0", NEXT_ROUNDED)])
def test_load_and_unload(engine, binary, value):
    engine.run("dump_to_train_file Rows title,tag,tags")
    engine.run(f"word2vec_train --min_count 1 --binary {binary}")
    assert engine.run(f"word2vec_load --binary {binary}") is True and engine.run("word2vec_unload") is True
    near(page(engine, f"word2vec_distance Coach --binary {binary}")[1][0], "sleeper", value)


def test_edit_distances_in_order(engine):
    """By distance, ties by ascending similarity."""
    engine.run("dump_to_train_file Rows title,tag,tags")
    engine.run("word2vec_train --min_count 1")
    r = engine.run("word2vec_distance Coach --edit_distance 1")
    got = [(x[0], x[1]) for x in r.rows().collect()]
    value = {x[0]: x[1] for x in engine.run("word2vec_distance Coach").rows().collect()}
    assert len(got) == 8 and got == sorted(got, key=lambda x: (x[1], value[x[0]]))


def test_expanded_search(spark):
    """Terms are expanded to their neighbours, and rows with any of them are found."""
    ships = [("Harbour", f"Port{i % 5 + 1}", ["Crane", "Pilotboat"]) for i in range(30)]
    rows = table(spark, [ONE, TWO, *ships, TWO])
    model = train(dump_corpus(rows, "title,tag,tags*9", id_col="_id", normalizer="none"), min_count=1, mode="init").model.df
    assert expand_query(model, "Crane") == "Crane"  # nothing is as near as the default threshold asks for
    assert expand_query(model, "Crane", threshold=0.15, limit=1) == "((Crane) OR (Pilotboat))"
    for options in ({}, {"threshold": 0.15, "limit": 1}):
        assert search(rows, "tags", "Crane", lambda q, o=options: expand_query(model, q, **o)).count() == 32
    assert distance(model, "Crane", normalizer="none", limit=1, threshold=0.15, expander_mode=True).expanded == "((Crane) OR (Pilotboat))"
