"""BPE codec, token files, media columns: exact round trips."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

tokenizers = pytest.importorskip("tokenizers")

from lexivane.llm import bpe, media, token_files  # noqa: E402
from lexivane.llm.queries import tokenizer_path  # noqa: E402

PATH = tokenizer_path()
RNG = random.Random(7)
TEXTS = [
    None, "", "  \n\t ", "Hello, world! It's ÄÖÜ they'll don't", "ΑΣ ΟΔΟΣ Σ", "a\x1cb \u0085c\xa0d", "é ́x İstanbul ſ ǅ",
    "<|endoftext|>x<|startoftext|> <|ENDOFTEXT|>", "a" * 5000, "".join(RNG.choice("the") for _ in range(9000)), "!?" * 700,
    "1234567890" * 90, "日本語テキスト" * 150, "퟿😀👨‍👩‍👧" * 40, "antidisestablishmentarianism" * 200,
    "".join(chr(RNG.choice([RNG.randint(33, 0x2FFF), RNG.randint(33, 120)])) for _ in range(5000)),
    " ".join("".join(RNG.choice("abcdeñü.,") for _ in range(RNG.randint(1, 12))) for _ in range(4000)),
]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def docs(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "x"), (3, "other text", "y"), (None, "no key", "z")]
    return spark.createDataFrame(rows, "doc_id long, text string, IDS string")


def test_tree_against_library(library):
    for tree in (True, False):
        c = bpe.TreeBpe(PATH, tree=tree)
        for t in TEXTS:
            want = library.encode(t or "", add_special_tokens=False).ids
            assert c.encode(t) == want
            assert c.decode(want) == library.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("leaf,window", [(2, 1), (5, 1), (16, 2), (64, 4)])
def test_joins_of_any_leaf(library, leaf, window):
    c = bpe.TreeBpe(PATH, leaf=leaf, window=window)
    for seed in range(30):
        r = random.Random(seed)
        t = "".join(r.choice(["th", "e", "in", "g", "tion", "ñ", "a"]) for _ in range(r.randint(1, 200)))
        assert c.encode(t) == library.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("text_leaf", [2, 3, 7, 40, 512])
def test_halves_of_whole_texts(library, text_leaf):
    """Cuts anywhere: inside words, special tokens, combining marks, contractions, runs of spaces."""
    c, r = bpe.TreeBpe(PATH, text_leaf=text_leaf), random.Random(text_leaf)
    texts = ["".join(r.choice(["th", "e", " ", "  ", "\n", "ing", "é", "e\u0301", "Σ", "İ", "<|endoftext|>", "日本", "\t", "'s", "123", "!?", " the "]) for _ in range(r.randint(1, 400))) for _ in range(120)] + TEXTS
    got = c.encode_batch(bpe.pa.array(texts, bpe.pa.string())).to_pylist()
    assert got == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert c.joins > 40


def test_ordinary_documents_take_the_tree(library):
    """Most documents are joined from halves, by as many joins as there are leaves but one."""
    import pyarrow.parquet as pq

    texts = [t or "" for t in pq.read_table("/root/testdata/sf0.001/documents.parquet").column("text").to_pylist()]
    c, halved, joins = bpe.TreeBpe(PATH), 0, 0
    for t in texts:
        before = c.joins
        assert c.encode(t) == library.encode(t, add_special_tokens=False).ids
        halved += c.joins > before
        joins += max(0, (len(t) - 1).bit_length() - 9)
    assert halved > len(texts) / 2 and c.joins >= joins
    before = c.joins
    c.encode_batch(bpe.pa.array(texts))
    assert c.joins == 2 * before


def test_decoded_name_that_is_taken(spark):
    out = bpe.decode(spark.createDataFrame([([1, 2], "x")], "ids array<int>, Decoded string"), PATH)
    assert out.columns == ["ids", "Decoded", "_decoded"] and out.head()._decoded == bpe.TreeBpe(PATH).decode([1, 2])


def test_codec_rows(spark, library):
    df = docs(spark)
    out = bpe.encode(df, PATH, decoded_col="decoded")
    assert out.columns == ["doc_id", "text", "IDS", "_ids", "decoded"]
    again = bpe.decode(out.drop("decoded"), PATH, "_ids")
    for r in again.collect():
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert r._ids == want and r.decoded == library.decode(want, skip_special_tokens=False)
    assert out.count() == df.count()
    assert bpe.encode(df.limit(0), PATH).count() == 0


def test_unknown_ids_decode_to_nothing(spark):
    df = spark.createDataFrame([([1, 999_999, -5, 2],), (None,), ([],)], "ids array<int>")
    c = bpe.TreeBpe(PATH)
    assert [r.decoded for r in bpe.decode(df, PATH).collect()] == [c.decode([1, 2]), "", ""]


def test_token_files(spark, library, tmp_path):
    df = docs(spark).drop("IDS")
    out = f"file://{tmp_path}/ids"
    token_files.write(df, out, PATH, shard_bytes=4000)
    got = token_files.read(spark, out, with_ids=True).orderBy("start").collect()
    assert len(got) == df.count()
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.ids[-1] == 1
        at += r.n_tokens
    keys = [r.doc_id for r in got]
    assert keys[0] is None and keys[1:] == sorted(keys[1:])
    want = sorted(library.encode(r.text or "", add_special_tokens=False).ids + [1] for r in df.collect())
    assert sorted(r.ids for r in got) == want
    slim = {(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in token_files.read(spark, out).collect()}
    assert slim == {(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got}
    assert token_files.manifest(spark, out).count() > 3
    found = token_files.lookup(spark, out, [None, 3, 8, 12345])
    assert found[12345] == [] and len(found[3]) == 3 and len(found[None]) == 1
    assert found[8] == [library.encode(TEXTS[8], add_special_tokens=False).ids + [1]]


def test_lookups_read_byte_ranges(spark, library, tmp_path):
    """A lookup reads its manifest rows, and of one shard a head, a block or two, a slot and the ids: not the shard."""
    out = f"file://{tmp_path}/ranges"
    df = spark.range(20_000).selectExpr("id * 3 AS doc_id", "concat('word', CAST(id AS STRING), ' and more words of it') AS text")
    token_files.write(df, out, PATH)
    shards = token_files.manifest(spark, out).collect()
    size = sum(f.stat().st_size for f in (tmp_path / "ranges").glob("part-*"))
    assert sum(r.n_docs for r in shards) == 20_000 and size > 500_000
    for key, text in ((0, "word0 and more words of it"), (29_997, "word9999 and more words of it"), (59_997, "word19999 and more words of it")):
        counted = []
        assert token_files.lookup(spark, out, [key], counted) == {key: [library.encode(text, add_special_tokens=False).ids + [1]]}
        assert len(counted) == 1 and counted[0] < 2000  # the hit and the next occurrence, which isn't there
    assert token_files.lookup(spark, out, [1, -5, None, 10**9]) == {1: [], -5: [], None: [], 10**9: []}


def test_keys_whose_hashes_agree(monkeypatch):
    monkeypatch.setattr(token_files, "key_hash", lambda k, n, o: np.where(np.asarray(k) % 3 == 0, np.uint64(77), np.asarray(k).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    data = token_files.pack(0, 0, np.arange(30), np.zeros(30, np.uint8), np.full(30, 2), np.arange(60), 2)
    shard = token_files.Shard(data)
    assert len(shard.spilled) == 10 and shard.find(shard.keys, shard.null, shard.occurrence)[0].tolist() == list(range(0, 60, 2))
    index = token_files.Index(lambda at, n: data[at : at + n])
    assert [index.find(k) for k in (0, 3, 29, 33, 31)] == [[0, 1], [6, 7], [58, 59], None, None]


def test_empty_token_files(spark, tmp_path):
    out = f"file://{tmp_path}/none"
    token_files.write(docs(spark).limit(0), out, PATH)
    assert token_files.read(spark, out).count() == 0


def test_perfect_hash():
    for n in (1, 2, 1000, 50_000):
        h = np.unique(np.random.default_rng(n).integers(0, 1 << 63, n).astype(np.uint64))
        index = token_files.PerfectHash.build(h)
        assert sorted(index.slots(h).tolist()) == list(range(len(h)))


def test_damaged_shard():
    data = token_files.pack(0, 0, np.array([1, 2]), np.zeros(2, np.uint8), np.array([2, 1]), np.array([5, 6, 7]), 2)
    assert token_files.Shard(data).find(np.array([2, 9]), np.zeros(2), np.zeros(2))[0].tolist() == [2, -1]
    with pytest.raises(ValueError):
        token_files.Shard(data[:-9] + bytes([data[-9] ^ 255]) + data[-8:])


def brute_media(text):
    raw = (text or "").encode()
    x = raw + bytes(64 - len(raw) % 64 if len(raw) % 64 or not raw else 0)
    m = media.wav(x)
    return len(raw), len(x), hashlib.sha256(x).hexdigest(), zlib.crc32(x[-64:]), len(m), hashlib.sha256(m).hexdigest(), media.features(x)


def test_media_columns(spark):
    rnd = np.random.default_rng(1)
    passage = "".join(map(chr, rnd.integers(97, 123, 30_000)))
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100 + i, passage[i * 10 :] + str(i)) for i in range(20)] + [(7, "copy")] * 40
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = media.media_columns(df).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, *r[1:]) for r in got) == sorted((i, *brute_media(t)) for i, t in rows)
    assert media.media_columns(df.limit(0)).count() == 0


def test_most_documents_have_several_chunks(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    sizes = [len(r.recipe) for r in media.recipes(docs).collect()]
    assert sum(n == 1 for n in sizes) < len(sizes) / 3 and sum(sizes) > 3 * len(sizes)


def test_the_store_goes_with_its_use(spark):
    df = spark.createDataFrame([(i, f"some text {i} " * 300) for i in range(30)], "doc_id long, text string")
    assert media.media_columns(df).count() == 30
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("lexivane_chunks_")]


def test_hot_chunks_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(media, "HOT_USES", 3)
    rnd = np.random.default_rng(2)
    passage = "".join(map(chr, rnd.integers(97, 123, 40_000)))
    df = spark.createDataFrame([(i, passage + str(i)) for i in range(12)], "doc_id long, text string")
    assert sorted((r.doc_id, *r[1:]) for r in media.media_columns(df).collect()) == sorted((i, *brute_media(passage + str(i))) for i in range(12))


def test_chunks_follow_content():
    rnd = np.random.default_rng(3)
    a = rnd.integers(0, 256, 200_000).astype(np.uint8).tobytes()
    b = b"new beginning" + a

    def names(x):
        ends = media.cuts(x)
        assert ends[-1] == len(x) and all(y - z <= media.MAX_CHUNK for y, z in zip(ends, [0, *ends]))
        return {media.name_of(x[s:e]) for s, e in zip([0, *ends], ends)}

    one, two = names(a), names(b)
    assert len(one & two) >= len(one) - 3


def test_words_are_encoded_once_where_texts_are_whole(library):
    """The coder of the token files keeps the words of many batches; one that can't hold them gives the same ids."""
    batches = [pa.array([" ".join(f"w{i:x}" for i in range(k, k + 5_000))]) for k in range(0, 150_000, 5_000)]
    c, asked = bpe.TreeBpe(PATH, tree=False, cache=bpe.coder(PATH, tree=False).cache), []
    words = c.words
    c.words = lambda runs: asked.append(len(runs)) or words(runs)
    once = [c.encode_batch(b).to_pylist() for b in batches]
    assert sum(asked) == 150_000
    assert [c.encode_batch(b).to_pylist() for b in batches] == once and sum(asked) == 150_000
    small = bpe.TreeBpe(PATH, tree=False, cache=7_000)
    assert [small.encode_batch(b).to_pylist() for b in batches[:4] * 2] == once[:4] * 2
    assert once[0][0] == library.encode(batches[0][0].as_py(), add_special_tokens=False).ids
