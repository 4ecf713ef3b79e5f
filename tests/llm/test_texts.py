"""Toxicity, quality, pages: held-out accuracy and edge cases."""

import itertools
import random
import time

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from lexivane.llm import html_blocks, html_extract, quality, toxicity

SYLLABLES = "ka lo mi re tu sha ven dor pel nis".split()
BAD_WORDS = ["vilescum", "trashfool", "hatemonger"]


def prose(r, n):
    return " ".join("".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 4))) for _ in range(n)).capitalize() + "."


def toxic_docs(n, seed):
    r = random.Random(seed)
    out = []
    for i in range(n):
        words = prose(r, r.randint(20, 200)).split()
        y = i % 4 == 0
        if y:
            for _ in range(r.randint(2, 6)):
                words[r.randrange(len(words))] = r.choice(BAD_WORDS)
        out.append((i, " ".join(words), int(y)))
    return out


def auc(score, label):
    p, q = np.array(score)[np.array(label) == 1], np.array(score)[np.array(label) == 0]
    return float((p[:, None] > q[None]).mean() + 0.5 * (p[:, None] == q[None]).mean())


def test_toxicity(spark):
    rows = toxic_docs(800, 1)
    df = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(None, "no key", "y"), (9000, None, "z"), (9001, "", "z"), (9002, "w" * 100_000, "z"), (0, rows[0][1], "again")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 3] + [(None, 1), (77_777, 1), (88_888, None)], "doc_id long, toxic int")
    model = toxicity.fit(df, labels)
    out = toxicity.score(df, model)
    assert out.columns == ["doc_id", "text", "score", "_score", "largest_distance"]
    got = out.collect()
    assert len(got) == df.count() and all(0 <= r._score <= 1 for r in got)
    by = {r.doc_id: r._score for r in got if r.score == "x"}
    held = [(by[i], y) for i, _, y in rows if i % 3 == 0]
    assert auc(*zip(*held)) > 0.98
    assert np.mean([(s >= toxicity.THRESHOLD) == y for s, y in held]) > 0.95
    assert len({r._score for r in got if r.doc_id in (9000, 9001)}) == 1
    assert toxicity.score(df.limit(0), model).count() == 0


def test_toxicity_without_both_labels(spark):
    df = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score(df, toxicity.fit(df, none)).head().score == 0.0
    one = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert toxicity.score(df, toxicity.fit(df, one)).head().score == 1.0


def test_toxicity_with_few_texts():
    rows = toxic_docs(200, 3)
    toxic, ordinary = [t for _, t, y in rows if y], [t for _, t, y in rows if not y]
    for some in (toxic[:2], []):
        model = toxicity.train(some, ordinary, 0.25)
        assert not model.weights and model.scores(["a", None], None)[0].tolist() == [0.25, 0.25]
    assert not toxicity.train(["x"] * 50, ["y"] * 50, 0.5).weights  # copies are one text


def test_distances_by_hand():
    rows = toxic_docs(400, 4)
    model = toxicity.train([t for _, t, y in rows if y], [t for _, t, y in rows if not y], 0.25)
    # Both dictionaries are zstandard's own; the toxic side has one's content before the other's.
    for d in (model.ordinary, model.toxic):
        assert zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_FULLDICT).dict_id() > 0
    assert b"scum" in model.toxic and b"scum" not in model.ordinary and len(model.toxic) <= toxicity.TOXIC_BYTES
    params = zstandard.ZstdCompressionParameters(**toxicity.SEARCH, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False)
    start = lambda d: d.index((1).to_bytes(4, "little") + (4).to_bytes(4, "little") + (8).to_bytes(4, "little")) + 12
    both = model.ordinary[: start(model.ordinary)] + model.toxic[start(model.toxic) :] + model.ordinary[start(model.ordinary) :]
    a, b = (zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_FULLDICT), compression_params=params) for d in (model.ordinary, both))
    texts = [t for _, t, _ in rows[:20]] + ["", "one", None, "WORDS " * 11]
    found = []
    for t in texts:
        words = (t or "").lower().split()
        cut = [" " + " ".join(words[i : i + 8]) + " " for i in range(0, max(1, len(words) - 4), 4)] if words else []
        d = [len(a.compress(w.encode())) - len(b.compress(w.encode())) for w in cut]
        assert model.distances(t, model.open()).tolist() == d
        found.append(d)
    x = model.features([np.array(d, float) for d in found])
    for row, d in zip(x, found):
        top = sorted(d)[::-1][:3] or [0]
        want = [top[0], np.mean(top), np.mean(d or [0])]
        for limit in model.limits:
            over = sum(v >= limit for v in d)
            want += [over**0.5, over / max(1, len(d))]
        assert np.allclose(row, want)


def test_windows_cover_every_word():
    for n in range(0, 40):
        words = [f"w{i}".encode() for i in range(n)]
        assert set(b" ".join(toxicity.windows(words)).split()) == set(words)


def quality_docs(n, seed):
    r = random.Random(seed)
    out = []
    for i in range(n):
        lines = [prose(r, r.randint(5, 30)) for _ in range(r.randint(1, 8))]
        y = i % 3 > 0
        if not y:
            kind = r.randint(0, 2)
            bad = lambda x: x.upper().replace(" ", "!! ") if kind == 0 else " | ".join(x.split()) if kind == 1 else " ".join(w for w in x.split()[:3] for _ in range(12))  # noqa: B023, E731
            lines = [bad(x) if r.random() < 0.9 or len(lines) < 3 else x for x in lines]
        out.append((i, "\n".join(lines), int(y)))
    return out


def test_quality(spark):
    rows = quality_docs(600, 2)
    df = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(None, "no key", "y"), (9000, None, "z"), (9001, " \n\n ", "z"), (9002, "line\n" * 20_000, "z"), (0, rows[0][1], "again")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 2 == 0] + [(None, 1), (5, None), (7, 9)], "doc_id long, quality int")
    model = quality.fit(df, labels)
    got = quality.score(df, model).collect()
    assert len(got) == df.count() and all(0 <= r._score <= 1 for r in got)
    by = {r.doc_id: r._score for r in got if r.score == "x"}
    held = [(by[i], y) for i, _, y in rows if i % 2]
    assert auc(*zip(*held)) > 0.98
    assert {r._score for r in got if r.doc_id in (9000, 9001)} == {0.0}
    assert quality.score(df.limit(0), model).count() == 0
    lines = quality.label_lines(df.filter("doc_id = 0 and score = 'x'"), model).orderBy("line_no").collect()
    assert [x.line for x in lines] == rows[0][1].split("\n") and all(0 <= x.marginal <= 1 for x in lines)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.score(df, quality.fit(df, none)).head()._score == 0.0


def test_forward_backward_against_enumeration():
    rng = np.random.RandomState(0)
    at = np.array([0, 4, 4, 5, 8, 10])
    pot, pair = rng.randn(10), rng.randn(2, 2)
    m, pairs, z = quality.forward_backward(pot, pair, at)
    want_pairs = np.zeros((2, 2))
    for k, (a, b) in enumerate(zip(at[:-1], at[1:])):
        if a == b:
            continue
        total, marginal, two = 0.0, np.zeros(b - a), np.zeros((2, 2))
        best = (-np.inf, None)
        for y in itertools.product((0, 1), repeat=b - a):
            e = sum(pot[a + i] * v for i, v in enumerate(y)) + sum(pair[y[i], y[i + 1]] for i in range(b - a - 1))
            best = max(best, (e, y))
            s = np.exp(e)
            total += s
            marginal += s * np.array(y)
            for i in range(b - a - 1):
                two[y[i], y[i + 1]] += s
        assert np.allclose(marginal / total, m[a:b]) and np.isclose(np.log(total), z[k])
        assert html_extract.viterbi(pot[a:b], pair).tolist() == list(best[1])
        want_pairs += two / total
    assert np.allclose(want_pairs, pairs)


def test_lines():
    lines, at = quality.lines_of(pa.array(["a\n\n b ", None, "", "c"]))
    assert lines.to_pylist() == ["a", " b ", "c"] and at.tolist() == [0, 2, 2, 2, 3]


def texts(page):
    return [b.text for b in html_blocks.blocks(page)]


@pytest.mark.parametrize("page,want", [
    (None, []),
    ("", []),
    ("plain", ["plain"]),
    ("<p>a<b>x<p>y &amp; &lt;z</b><br>w", ["ax", "y & <z w"]),
    ("<table><tr><td>1<td>2</table><ul><li>q<li>r</ul>3 < 4", ["1", "2", "q", "r", "3 < 4"]),
    ("<script>if(a<b)</script>tail<style>x", ["tail"]),
    ("<!-- a <p>b --> c <![CDATA[d]]> <!doctype x>", ["c"]),
    ("<div>a</span></nosuch>b</div>", ["ab"]),
    ("<p>a\n\t b&nbsp;c", ["a b c"]),
    ("<a href='x>y'>z</a>", ["z"]),
    ("<div" + "<div>" * 3 + "deep", ["deep"]),
    ("<p>unended <b", ["unended"]),
    ("<p>a</p><svg/><p>b</p><svg><text>x</text></svg><p>c</p>", ["a", "b", "c"]),
    ("see <math><mi>x</mi></math> here, <object>or</object> <noscript>there</noscript>.", ["see x here, or there."]),
    ("<template>a<template>b</template>c</template>tail<svg>open <p>end", ["tailopen", "end"]),
    ("<p class=don't>one</p><p>it's</p>", ["one", "it's"]),
    ("a<!-->b<!-- x --!>c<xmp><i>&amp;</xmp><iframe>no</iframe>d", ["abc", "<i>&amp;", "d"]),
    ("<my-card>a</my-card> <nosuch>b</nosuch><p hidden>c", ["a b", "c"]),
    ("<p>one<li>two<dl><dt>x<dd>y</dl>z", ["one", "two", "x", "y", "z"]),
])
def test_blocks(page, want):
    assert texts(page) == want


def test_very_deep_and_long_pages():
    began = time.process_time()
    assert texts("<div>" * 100_000 + "x") == ["x"]
    assert len(texts("<div>word" * 20_000)) == 20_000
    assert len(texts("<p>word</p>" * 50_000)) == 50_000
    assert len(texts("<div>" * 10_000 + "<li>a</li></span></i>" * 10_000)) == 10_000
    assert texts("<svg>" * 20_000 + "x") == ["x"] and texts("<a b=" * 20_000) == []
    assert time.process_time() - began < 10
    assert len("\n\n".join(html_extract.train().main_blocks("<article>" + "<div>" * 5000 + "<p>Some words of a text, which go on.</p>" * 20_000))) > 700_000


def test_potentials_in_parts(monkeypatch):
    model = html_extract.train()
    for rows in (1, 3, 4096):
        monkeypatch.setattr(html_extract, "ROWS", rows)
        for page, _ in html_extract.labelled_pages(20, 5):
            found = html_extract.blocks_of(page)
            assert np.allclose(html_extract.potentials(found, model.weights), html_extract.features(found) @ model.weights)


def test_pages_without_article():
    """Pages that are composed as the training ones, but never with an article or main element."""
    model, exact = html_extract.train(), []
    for page, labels in html_extract.labelled_pages(300, 99):
        if "<article" in page or "<main" in page:
            continue
        found = html_extract.blocks_of(page)
        exact.append(np.mean(html_extract.viterbi(html_extract.potentials(found, model.weights), model.pair) == np.array(labels)))
    assert len(exact) > 30 and np.mean(exact) > 0.93


def test_pages_held_out():
    model = html_extract.train()
    exact = hits = found = wanted = 0
    pages = html_extract.labelled_pages(120, 77)
    for page, labels in pages:
        blocks = html_blocks.blocks(page)
        got = html_extract.viterbi(html_extract.features(blocks) @ model.weights, model.pair).tolist()
        exact += got == labels
        hits += sum(a & b for a, b in zip(got, labels))
        found, wanted = found + sum(got), wanted + sum(labels)
    assert hits / found > 0.95 and hits / wanted > 0.97 and exact / len(pages) > 0.8


def test_extract(spark):
    page = '<html><body><nav><ul><li><a href="/a">Menu</a></ul></nav><div class="ad">Buy this now.</div><article><h1>Title here</h1><p>First &eacute;  line of text, which is long enough.<p>Second line. And more of it follows here.</article><footer>&copy; x</footer>'
    df = spark.createDataFrame([(1, page, "n"), (1, page, "n"), (2, None, "n"), (None, "", None)], "page_id long, html string, text string")
    out = html_extract.extract(df)
    assert out.columns == ["page_id", "html", "text", "_text", "n_chars"]
    got = out.collect()
    assert got[0]._text == "Title here\n\nFirst é line of text, which is long enough.\n\nSecond line. And more of it follows here."
    assert got[0] == got[1] and got[0].n_chars == len(got[0]._text) and [r._text for r in got[2:]] == ["", ""]
    assert html_extract.extract(df.limit(0)).count() == 0
