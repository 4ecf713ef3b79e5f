"""The operators' registered queries on the smallest tables: SQL where there is some, brute force elsewhere."""

import hashlib
import html.parser
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from lexivane.llm import media, quality, toxicity
from lexivane.llm.queries import ORACLE_SQL, QUERIES, quality_model, tokenizer_path, toxicity_model
from tests.oracle import connect, rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_sql(spark, duck, name):
    got, want = QUERIES[name](spark, SF).toPandas(), duck.sql(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows_of(got) == rows_of(want)


@pytest.mark.parametrize("name,module,folds,held", [("op1_toxicity", toxicity, 4, 2), ("op2_quality", quality, 5, 0)])
def test_scores(spark, duck, name, module, folds, held):
    got = QUERIES[name](spark, SF).collect()
    assert len(got) == duck.sql("SELECT count(*) FROM documents").fetchall()[0][0]
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == held)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= module.THRESHOLD)


def test_toxicity_by_hand(spark, duck):
    """Scores of the query from window lengths taken one by one, with features and curve written out."""
    texts = dict(duck.sql("SELECT doc_id, text FROM documents").fetchall())
    model = toxicity_model(spark, SF)
    got = {r.doc_id: r for r in QUERIES["op1_toxicity"](spark, SF).collect()}
    assert set(got) == set(texts)
    a, b = model.open()
    for k, t in texts.items():
        words = [w[i : i + 64] for w in re.findall(rb"[^\x20\x09-\x0D]+", (t or "").lower().encode()) for i in range(0, len(w), 64)]
        cut = [b" " + b" ".join(words[i : i + 8]) + b" " for i in range(0, max(1, len(words) - 4), 4)] if words else []
        d = [len(a(w)) - len(b(w)) for w in cut]
        x = [max(d, default=0), np.mean(sorted(d)[-3:] or [0]), np.mean(d or [0])]
        for limit in model.limits:
            x += [np.sqrt(sum(v >= limit for v in d)), np.mean([v >= limit for v in d] or [0])]
        z = model.weights[0] + sum(w * (v - c) / s for w, v, c, s in zip(model.weights[1:], x, model.centre, model.spread)) if model.weights else None
        assert got[k].score == pytest.approx(model.prior if z is None else 1 / (1 + np.exp(-np.clip(z, -40, 40))), abs=1e-9)


def test_quality_by_hand(spark, duck):
    """Scores of the query from chains stepped line by line in plain numbers."""
    texts = dict(duck.sql("SELECT doc_id, text FROM documents").fetchall())
    model = quality_model(spark, SF)
    got = {r.doc_id: r.score for r in QUERIES["op2_quality"](spark, SF).collect()}
    assert set(got) == set(texts)
    for k, t in texts.items():
        lines = [x for x in (t or "").split("\n") if x.strip()]
        if not lines:
            assert got[k] == 0
            continue
        own = [quality.line_features(pa.array([x]))[0] for x in lines]
        none = np.zeros_like(own[0])
        potential = []
        for i in range(len(lines)):
            x = [1.0, *own[i], *(own[i - 1] if i else none), *(own[i + 1] if i + 1 < len(own) else none), float(i == 0), float(i == len(lines) - 1)]
            potential.append(float(np.dot(x, model.weights)))
        forward, backward, pair = [], [None] * len(lines), np.exp(model.pair)
        for i, p in enumerate(potential):
            v = np.array([1.0, np.exp(p)]) * (1 if i == 0 else forward[-1] @ pair)
            forward.append(v / v.sum())
        backward[-1] = np.ones(2)
        for i in range(len(lines) - 2, -1, -1):
            v = pair @ (np.array([1.0, np.exp(potential[i + 1])]) * backward[i + 1])
            backward[i] = v / v.sum()
        good = [(f * b)[1] / (f * b).sum() for f, b in zip(forward, backward)]
        mean = np.clip(np.average(good, weights=[len(x) for x in lines]), 1e-3, 1 - 1e-3)
        z = model.curve[0] + model.curve[1] * np.log(mean / (1 - mean))
        assert got[k] == pytest.approx(1 / (1 + np.exp(-np.clip(z, -40, 40))), abs=1e-6)


def test_media(spark, duck):
    texts = dict(duck.sql("SELECT doc_id, text FROM documents").fetchall())
    got = QUERIES["op3_media_columns"](spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        raw = (texts[r.doc_id] or "").encode()
        x = media.payload(raw)
        m = media.wav(x)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32, r.media_bytes, r.media_sha256, r.feature) == (len(raw), len(x), hashlib.sha256(x).hexdigest(), zlib.crc32(x[-64:]), len(m), hashlib.sha256(m).hexdigest(), media.features(x))


class Article(html.parser.HTMLParser):
    """What stands between <article> and </article>, by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.parts = 0, [""]

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        if tag in ("p", "h1", "h2", "li", "div", "article"):
            self.parts.append("")
        elif tag == "br":
            self.parts[-1] += " "

    def handle_endtag(self, tag):
        if tag in ("p", "h1", "h2", "li", "div", "article"):
            self.parts.append("")
        self.inside -= tag == "article"

    def handle_data(self, data):
        if self.inside:
            self.parts[-1] += data


def article_of(page):
    x = Article()
    x.feed(page)
    x.close()
    return "\n\n".join(t for t in (" ".join(p.split()) for p in x.parts) if t)


def test_pages(spark, duck):
    pages = dict(duck.sql("SELECT page_id, html FROM pages").fetchall())
    got = QUERIES["op4_html_extract"](spark, SF).collect()
    assert sorted(r.page_id for r in got) == sorted(pages)
    assert sum(r.text == article_of(pages[r.page_id]) for r in got) >= 0.99 * len(pages) and all(r.n_chars == len(r.text) for r in got)


def test_tokens(spark, duck):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    rows = duck.sql("SELECT doc_id, coalesce(text, '') FROM documents ORDER BY doc_id").fetchall()
    coded = {k: library.encode(t, add_special_tokens=False).ids for k, t in rows}
    codec = {r.doc_id: r for r in QUERIES["op9_bpe_codec"](spark, SF).collect()}
    files = {r.doc_id: r for r in QUERIES["op10_token_files"](spark, SF).collect()}
    assert set(codec) == set(files) == set(coded)
    start = 0
    for k, _ in rows:
        ids = coded[k]
        c, f = codec[k], files[k]
        assert (c.n_tokens, c.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert c.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        assert (f.start, f.n_tokens, f.ids_crc32) == (start, len(ids) + 1, zlib.crc32(np.array([*ids, 1], "<u4").tobytes()))
        start += len(ids) + 1
