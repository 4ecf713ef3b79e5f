"""Similarities that depend on the vocabulary's order alone: seeded vectors, published expectations."""

import pytest

from lexivane.operators.corpus import dump_corpus
from lexivane.operators.distance import distance
from lexivane.operators.train import train

A = (1, "AlphaText", "Lib", ["Gamma", "Delta"])
B = (2, "Database", "Server", ["Sql", "Postsql"])
SCHEMA = "_id long, title string, tag string, tags array<string>"


def made(spark, rows, columns="title,tag,tags", min_count=1, normalizer="auto", decimals=None, **options):
    df = spark.createDataFrame([(i + 1, *r[1:]) for i, r in enumerate(rows)], SCHEMA)
    corpus = dump_corpus(df, columns, id_col="_id", normalizer=normalizer, **options)
    return train(corpus, min_count=min_count, mode="init", decimals=decimals, sentence_vectors=options.get("sentence_vectors", False)).model.df


def found(model, term, **options):
    r = distance(model, term, **options)
    return r.nhits(), [tuple(x) for x in r.rows().collect()]


@pytest.fixture(scope="module")
def base(spark):
    return made(spark, [A, B]).persist()


@pytest.mark.parametrize("term,options,nhits,first,value", [
    ("Gamma", {}, 8, "delta", 0.12582902610302),
    ("Gamma", {"offset": 3, "limit": 3}, 8, "postsql", -0.0281914249062538),
    ("Gamma + Database", {}, 7, "delta", 0.174095034599304),
    ("Gamma - Database - Delta", {}, 6, "postsql", 0.141565784811974),
    ("Gamma + Delta", {}, 7, "alphatext", 0.06215425953269),
    ("Gamma", {"threshold": 0.0001}, 2, "delta", 0.12582902610302),
    ("Gamma", {"prefix_filter": "del"}, 1, "delta", 0.12582902610302),
    ("Gamma", {"stop_filter": "delta"}, 7, "alphatext", 0.0368562042713165),
    ("Gamma", {"output_filter": "lta"}, 8, "de", 0.12582902610302),
])
def test_base(base, term, options, nhits, first, value):
    n, rows = found(base, term, **options)
    assert n == nhits and rows[0][0] == first and rows[0][1] == pytest.approx(value, abs=2e-6)


@pytest.mark.parametrize("term", ["+ Gamma Delta", "Gamma +Delta", "Gamma+ Delta", "Gamma Delta+", "Gamma Delta +", "nosuch"])
def test_signs_outside_their_place_are_words(base, term):
    r = distance(base, term)
    assert r.oov and r.nhits() == 0


def test_pca(base):
    r = distance(base, "Gamma", pca=2)
    rows = r.rows().collect()
    assert r.nhits() == 9 and rows[0][0] == "gamma" and rows[0][1] == 1.0
    assert [abs(x) for x in rows[0][2:]] == pytest.approx([0.0166809968650341, 0.60534143447876], abs=1e-4)


def test_repeat(spark):
    n, rows = found(made(spark, [A, B], "title,tag*2,tags"), "Gamma")
    assert n == 8 and rows[0][0] == "alphatext" and rows[0][1] == pytest.approx(0.12582902610302, abs=2e-6)


def test_min_count(spark):
    n, rows = found(made(spark, [A] * 5 + [B], min_count=5), "Gamma")
    assert n == 4 and rows[0][0] == "delta"


def test_label(spark):
    n, rows = found(made(spark, [A, B], "title[tag:],tag,tags"), "tag:alphatext")
    assert n == 8 and rows[0][0] == "lib" and rows[0][1] == pytest.approx(0.18340303003788, abs=2e-6)


def test_phrase(spark):
    row = (1, "Alpha Text", "L ib", ["Gam ma", "Delta"])
    n, rows = found(made(spark, [row, B], "title_,tag_,tags_"), "alpha_text")
    assert rows[0][0] == "l_ib" and rows[0][1] == pytest.approx(0.18340303003788, abs=2e-6)
    assert found(made(spark, [row, B], "title_,tag_,tags_"), "Alpha Text", is_phrase=True)[1][0][0] == "l ib"


def test_symbols(spark):
    rows = [(1, "今日は＊雨だ1\",.;:&^/-#'()[]なぁ", "Library", []), (2, "明日は<b>晴れ</b>だなぁ", "Server", [])]
    n, got = found(made(spark, rows, "title$,tag"), "Server", limit=40)
    assert n == 7 and got[0][0] == "なぁ" and got[0][1] == pytest.approx(0.236046344041824, abs=2e-6)


def test_letters(spark):
    rows = [(1, "今日is雨だ", "Library", []), (2, "明日is晴れ", "Server", [])]
    n, got = found(made(spark, rows, "title@$,tag"), "Server", limit=40)
    assert n == 6 and got[0][0] == "</s>" and got[0][1] == pytest.approx(0.117504417896271, abs=2e-6)


def test_n_sort(spark):
    rows = [A, (1, "AlphaText", "Lib", ["Gamma", "Mroo"]), (1, "AlphaText", "Lib", ["Gamma", "Droo"]), B]
    m = made(spark, rows).persist()
    n, got = found(m, "Gamma", n_sort=2)
    assert n == 2 and got[0][0] == "sql" and got[0][1] == pytest.approx(0.164409309625626, abs=2e-6)
    assert found(m, "Gamma", n_sort=-1)[0] == 10


def test_sentence_vectors(spark):
    m = made(spark, [A, B, B], sentence_vectors=True).persist()
    n, got = found(m, "doc_id:2", sentence_vectors=True)
    assert n == 2 and got[0][0] == "doc_id:3" and got[0][1] == pytest.approx(0.144161820411682, abs=2e-6)
    table = spark.createDataFrame([(i + 1, *r[1:]) for i, r in enumerate([A, B, B])], SCHEMA)
    r = distance(m, "doc_id:2", sentence_vectors=True, table=table, id_col="_id", columns="title,tag", sortby="-title")
    assert [tuple(x) for x in r.rows().collect()] == [("Database", "Server"), ("AlphaText", "Lib")]
    assert [x[0] for x in distance(m, "doc_id:2", sentence_vectors=True, table=table, id_col="_id").rows().collect()] == [3, 1]


def test_six_decimals(spark):
    n, got = found(made(spark, [A, B], decimals=6), "Gamma")
    assert got[0][1] == pytest.approx(0.125836715102196, abs=2e-6)


def test_expander(spark):
    tags = [(1, "Database", f"Server{i % 5 + 1}", ["Sql", "Postsql"]) for i in range(40)]
    m = made(spark, [A, *tags, B], "title,tag,tags*9")
    assert distance(m, "Sql", limit=1, threshold=0.15, expander_mode=True).expanded == "((sql) OR (postsql))"


def test_normalizer_none(spark):
    n, got = found(made(spark, [A, B], normalizer="none"), "Gamma", normalizer="none")
    assert got[0][0] == "Delta"


def test_filters(spark):
    df = spark.createDataFrame([(1, "AlphaText", 2003), (2, "Database", 2010)], "_id long, title string, year int")
    lines = lambda f: [r.line for r in dump_corpus(df, "title", f, "_id").collect()]
    assert lines('title @ "alphatext"') == ["alphatext"]
    assert lines("year >= 2010") == ["database"]
    assert lines('year >= 2010 || title @ "text"') == ["alphatext", "database"]


def test_edit_distance(base):
    r = distance(base, "Gamma", edit_distance=True, compat=True)
    got = {x[0]: x[1] for x in r.rows().collect()}
    assert got["delta"] == 4 and got["sql"] == 4
    assert {x[0]: x[1] for x in distance(base, "Gamma", edit_distance=True).rows().collect()}["delta"] == 4
