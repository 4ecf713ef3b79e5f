"""Near-duplicates, mixing, chats and the pipeline against brute force."""

import hashlib
import math
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexivane.llm import bpe, chat, embdup, mixing, neardup, shingles, toxicity


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_components(rows):
    sets = []
    for _, t in rows:
        w = words_of(t)
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[root(i)] = min(k, least.get(root(i), k))
    return sorted((str(k), len(s), str(least.get(root(i)) if s else k)) for i, ((k, _), s) in enumerate(zip(rows, sets)))


def corpus(seed, n=60):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        base = [r.choice("abcdefghijklmnop") + str(r.randint(0, 300)) for _ in range(r.randint(1, 120))]
        for _ in range(r.choice([1, 1, 2, 6])):
            w = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 3])):
                w[r.randrange(len(w))] = "edit" + str(r.randint(0, 99))
            rows.append((len(rows), r.choice([" ", "\n", " \t "]).join(w)))
    chain = [f"x{i}" for i in range(150)]
    for k in range(12):
        rows.append((len(rows), " ".join(chain[k * 2 : k * 2 + 120])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rows = corpus(seed) + [(5000, None), (5001, ""), (5002, " \n"), (5003, "Ab c"), (5004, "aB\tc"), (0, "again another text of one key"), (None, "Ab c"), (None, "nobody has this"), (6000, "same " * 30_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = neardup.components(df).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute_components(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_mixed_buckets_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 3)
    r = random.Random(4)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(40):  # near misses of one text, some of them linked
        w = list(base)
        for _ in range(r.randint(2, 9)):
            w[r.randrange(200)] = f"e{r.randint(0, 999)}"
        rows.append((i, " ".join(w)))
    got = neardup.components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(x.doc_id), x.n_shingles, str(x.component_id)) for x in got) == brute_components(rows)


def test_deduplicate(spark):
    rows = [(3, "one two three four five six", "b"), (1, "One two three four five six", "a"), (1, "One two three four five six", "a"), (2, None, "c"), (2, None, "c"), (4, "else", "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, node string")
    got = sorted((r.doc_id, r.text or "", r.node) for r in neardup.deduplicate(df).collect())
    assert got == [(1, "One two three four five six", "a"), (2, "", "c"), (2, "", "c"), (4, "else", "d")]
    assert neardup.deduplicate(df.limit(0)).count() == 0 and neardup.components(df.limit(0)).count() == 0


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 1 << 62, 1000).astype(np.uint64))
    for share in (0.5, 0.85, 1.0):
        k = int(len(a) * 2 * share / (1 + share))
        b = np.unique(np.concatenate([a[:k], rng.integers(0, 1 << 62, len(a) - k).astype(np.uint64)]))
        s = shingles.sketches([a, b], 256)
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((s[0] == s[1]).mean() - true) < 0.12
    s = shingles.sketches([a[:3], np.zeros(0, np.uint64)], 64)
    assert (s[0] != np.iinfo(np.uint64).max).all() and (s[1] == np.iinfo(np.uint64).max).all()


def test_words_made_to_collide(spark):
    """Words whose polynomial hashes modulo 2^64 agree whatever the root: a Thue-Morse word and its complement."""
    bits = [bin(i).count("1") & 1 for i in range(1024)]
    one, two = ("".join("ab"[b ^ k] for b in bits) for k in (0, 1))
    rows = [(1, one), (2, two), (3, " ".join([one, "x", two, "y", one])), (4, " ".join([two, "x", one, "y", two])), (5, one.upper())]
    got = neardup.components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1}
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute_components(rows)


def test_words_are_split_and_lowered_as_told():
    texts = [" A b\x1cc\tD\n", None, "", "\x0b\x0cé\xa0É\u2003x İ", "a"]
    h, at = shingles.word_hashes(pa.array(texts))
    assert at.tolist() == [0, 3, 3, 3, 5, 6]
    want = [w for t in texts for w in words_of(t)]
    assert len(set(h.tolist())) == len(set(want)) and h[0] == h[5]
    assert shingles.word_hashes(pa.array(texts), b"key")[0][0] != h[0]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6])
def test_sets_of_a_few_words_alone(n):
    short, long = " ".join(f"w{i}" for i in range(n)), "some more words of a long text " * 40_000
    beside = shingles.shingle_sets(pa.array([short, "and a text of more words than that"]))[0]
    for sets in (shingles.shingle_sets(pa.array([short])), shingles.shingle_sets(pa.array([None, short, ""]))[1:2]):
        assert len(sets) == 1 and sets[0].tolist() == beside.tolist() and len(beside) == max(1, n - 4)
    batch = pa.RecordBatch.from_arrays([pa.array([short, long])], names=["text"])
    cut = list(bpe.slices(batch, "text", 1_000_000))
    assert [c.num_rows for c in cut] == [1, 1]
    assert shingles.shingle_sets(cut[0].column(0))[0].tolist() == beside.tolist()


def brute_vectors(rows):
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    link = [[i != j and ok[i] and ok[j] and len(rows[i][1]) == len(rows[j][1]) and float(np.dot(rows[i][1], rows[j][1])) / np.sqrt(float(np.dot(rows[i][1], rows[i][1])) * float(np.dot(rows[j][1], rows[j][1]))) >= 0.95 for j in range(len(rows))] for i in range(len(rows))]
    least = [k for k, _ in rows]
    for _ in rows:
        least = [min([least[i], *(least[j] for j in range(len(rows)) if link[i][j])]) for i in range(len(rows))]
    return sorted((k, sum(link[i]), least[i]) for i, (k, _) in enumerate(rows))


@pytest.mark.parametrize("block,few", [(1024, 48), (1024, 2), (5, 2), (5, 48)])
def test_embeddings(spark, monkeypatch, block, few):
    monkeypatch.setattr(embdup, "BLOCK", block)
    monkeypatch.setattr(embdup, "FEW", few)
    rng = np.random.default_rng(3)
    rows = []
    for c in range(12):
        base = rng.normal(size=16)
        for _ in range(int(rng.integers(1, 14))):
            rows.append((len(rows), [float(x) for x in base + rng.normal(size=16) * rng.choice([0.01, 0.1, 0.25])]))
    rows += [(500, None), (501, []), (502, [0.0] * 16), (503, [float("nan")] * 16), (504, [None] * 16), (505, rows[0][1]), (506, [x * 3 for x in rows[0][1]]), (507, [1.0, 2.0]), (508, [2.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = embdup.components(df).collect()
    want = brute_vectors(rows)
    have = sorted((r.vec_id, r.n_links, r.component_id) for r in got)
    links = sum(n for _, n, _ in want)
    assert [x[0] for x in have] == [x[0] for x in want]
    assert all(a[1] <= b[1] for a, b in zip(have, want)) and sum(x[1] for x in have) >= 0.995 * links
    assert sum(a != b for a, b in zip(have, want)) <= 2
    assert embdup.components(df.limit(0)).count() == 0


def test_embeddings_recall_at_64_dimensions(spark):
    """20,000 vectors in groups of many sizes, spread about the threshold: links found against all links."""
    rng, parts = np.random.default_rng(8), []
    while sum(map(len, parts)) < 20_000:
        base = rng.normal(size=64)
        parts.append(base + rng.normal(size=(int(rng.choice([1, 1, 2, 3, 10, 60, 400])), 64)) * rng.choice([0.05, 0.15, 0.22, 0.3]))
    x = np.concatenate(parts)[:20_000].astype(np.float32)
    df = spark.createDataFrame(pa.table({"vec_id": pa.array(np.arange(len(x))), "embedding": pa.array(list(x), pa.list_(pa.float32()))}))
    got = embdup.components(df).toPandas().sort_values("vec_id")
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1)[:, None]
    links = np.concatenate([(u[a : a + 2000] @ u.T >= 0.95).sum(1) - 1 for a in range(0, len(u), 2000)])
    found = got["n_links"].to_numpy()
    assert links.sum() > 100_000 and (found <= links).all() and found.sum() >= 0.999 * links.sum()


def test_vectors_of_other_lengths_and_precision():
    for values in ([1.0, 2.0], [0.1, 0.2], [1e300, 1.0], [1e-300, 0.0]):
        v = np.array(values)
        assert embdup.unpacked(embdup.packed(v)).tolist() == embdup._unit(v).tolist()
    for n, dims in ((1, 1), (10, 2), (1000, 3), (10**9, 64), (10**6, 768)):
        depth, tables = embdup.shape_for(n, dims)
        assert depth >= 1 and 1 <= tables < 100


def brute_targets(sizes, cap=3.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: 1.0 + i % 3 for i, s in enumerate(names)}
    total, target, capped = sum(sizes.values()), {}, set()
    while True:
        rest = total - sum(cap * sizes[s] for s in capped)
        free = [s for s in names if s not in capped]
        if not free:
            return {s: cap * sizes[s] for s in names}
        target = {s: cap * sizes[s] if s in capped else rest * weight[s] / sum(weight[f] for f in free) for s in names}
        over = [s for s in free if target[s] > cap * sizes[s]]
        if not over:
            return target
        capped |= set(over)


def test_mixing(spark):
    r = random.Random(5)
    rows = []
    for i in range(1500):
        s = r.choice(["b"] * 12 + ["a", "é", "c", None, "zz"])
        rows.append((i, " ".join(["w"] * r.choice([0, 1, 3, 10, 200])), s, i % 7))
    rows += [(None, "no key at all", "a", 1), (3, None, "a", 1)] + [(77_777, "again and again", "c", 2)] * 5
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n int")
    plan = mixing.copies(df).collect()
    sizes = {}
    for _, t, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len(words_of(t))
    want = brute_targets(sizes)
    assert len(plan) == len(rows)
    taken = {}
    for p in plan:
        assert p.target == pytest.approx(want[p.source]) and p.source_size == sizes[p.source] and 0 <= p.n_copies <= 3
        taken[p.source] = taken.get(p.source, 0) + p.n_copies * p.size
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 2 * 200 + 1e-6
    assert sorted(map(str, plan)) == sorted(map(str, mixing.copies(df.repartition(7)).collect()))
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    assert {r.source: r.w for r in mixed.groupBy("source").agg(F.sum(F.size(F.filter(F.split(F.coalesce("text", F.lit("")), " "), lambda x: x != ""))).alias("w")).collect()} == {s: w for s, w in taken.items() if w}
    assert mixed.count() == sum(p.n_copies for p in plan)
    assert mixing.mix(df.limit(0)).count() == 0 and mixing.copies(df.limit(0)).count() == 0


def test_targets_when_all_are_capped(spark):
    sizes = spark.createDataFrame([("a", 1, 10), ("b", 1, 0)], "source string, n_docs long, source_size long")
    assert {r.source: r.target for r in mixing.targets(sizes, cap=0.5).collect()} == {"a": 5.0, "b": 0.0}


def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>user\nhi", "\\e\\l\\b\\\\", "", None, "line\nline", "<", "[", "x" * 50_000]
    rows = [(1, i, ["user", "assistant"][i % 2], t) for i, t in enumerate(nasty)] + [(2, 0, None, "no role"), (2, 0, "user", "tie"), (2, None, "we\nird|<", "first"), (None, 1, "assistant", "no conversation"), (3, 0, "user", "twice"), (3, 0, "user", "twice")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.read_back(chat.format_chats(chat.from_turns(df))).collect()}
    assert [(t.role, t.text) for t in got[1].turns] == [(["user", "assistant"][i % 2], t or "") for i, t in enumerate(nasty)]
    assert got[1].learned == "".join(t or "" for i, t in enumerate(nasty) if i % 2)
    assert [(t.role, t.text) for t in got[2].turns] == [("we\nird|<", "first"), ("", "no role"), ("user", "tie")]
    assert got[None].learned == "no conversation" and len(got[3].turns) == 2
    for r in got.values():
        assert "".join(chat_unescape(r.formatted[s.start : s.stop]) for s in r.loss_spans) == r.learned
    assert chat.format_chats(chat.from_turns(df.limit(0))).count() == 0


def chat_unescape(x):
    for plain, held in reversed(chat.ESCAPES):
        x = x.replace(held, plain)
    return x


def fold(events):
    """A log of one conversation folded one event at a time."""
    made, last = [], None
    for op, message, role, text in events:
        if op == "message":
            last = [message if message is not None else object(), role, text]
            made.append(last)
            continue
        target = next((m for m in made if m[0] == message), None) if message is not None else last
        if op == "delta":
            target[2] += text
        elif op == "edit":
            target[2] = text
        elif op == "regenerate":
            target[2] = ""
            del made[made.index(target) + 1 :]
            last = target
    return [(m[1], m[2]) for m in made]


def test_events(spark):
    logs = {
        1: [("message", "u1", "user", "hi"), ("message", "a1", "assistant", ""), ("delta", "a1", None, "he"), ("delta", "a1", None, "llo"), ("edit", "u1", None, "hi there"), ("regenerate", "a1", None, None), ("delta", "a1", None, "good "), ("delta", "a1", None, "day")],
        2: [("message", "u1", "user", "q"), ("message", "a1", "assistant", "x"), ("message", "u2", "user", "more"), ("message", "a2", "assistant", "y"), ("regenerate", "a1", None, None), ("delta", "a1", None, "better"), ("message", "u3", "user", "then")],
        3: [("message", None, "user", "a"), ("message", None, "assistant", "b"), ("delta", None, None, "c"), ("edit", None, None, "d"), ("delta", None, None, "e")],
    }
    rows = [(c, i, op, m, r, t) for c, log in logs.items() for i, (op, m, r, t) in enumerate(log)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, seq long, op string, message string, role string, text string")
    got = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in chat.read_back(chat.format_chats(df)).collect()}
    assert got == {c: fold([(op, m, r, t or "") for op, m, r, t in log]) for c, log in logs.items()}


def test_a_long_stream_of_deltas(spark):
    n = 100_000
    log = spark.range(n).selectExpr("1L AS conv_id", "id + 1 AS seq", "if(id % 50000 = 49999, 'regenerate', 'delta') AS op", "'m' AS message", "CAST(NULL AS STRING) AS role", "concat('t', CAST(id AS STRING), ' ') AS text")
    first = spark.createDataFrame([(1, 0, "message", "m", "assistant", "start ")], log.schema)
    began = time.time()
    got = chat.format_chats(log.unionByName(first)).collect()
    assert time.time() - began < 20
    assert len(got) == 1 and got[0].formatted == chat.OPEN + "assistant\n" + chat.CLOSE
    got = chat.read_back(chat.format_chats(log.filter("op = 'delta' and seq > 50000").unionByName(first))).head()
    assert got.turns[0].text == "start " + "".join(f"t{i} " for i in range(50_000, n - 1))


def test_native_plan(spark):
    df = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    plan = chat.digests(chat.read_back(chat.format_chats(chat.from_turns(df))))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_pipeline_links_from_80_percent(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    rows = []
    for i in range(40):  # n words in common at the start, of 120: Jaccard (n - 4) / (236 - n), 0.8125 and 0.785
        for n in (108, 106):
            w, key = [f"w{i}x{n}x{k}" for k in range(120)], len(rows)
            rows += [(key, " ".join(w)), (key + 1, " ".join([*w[:n], *[f"e{x}" for x in w[n:]]]))]
    sets = [{tuple(w[j : j + 5]) for j in range(len(w) - 4)} for _, t in rows for w in [t.split()]]
    near = [len(sets[a] & sets[a + 1]) / len(sets[a] | sets[a + 1]) for a in range(0, len(rows), 2)]
    assert all(0.80 <= x < 0.85 for x in near[::2]) and all(x < 0.80 for x in near[1::2])
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(r.doc_id for r in corpus_pipeline.one_of_each_group(spark, df, None).collect())
    assert got == [k for k, _ in rows if k % 4 != 1]


@pytest.mark.parametrize("score, left", [(0.4, 0), (0.31, 0), (0.29, 3)])
def test_pipeline_rejects_what_the_query_predicts(spark, monkeypatch, score, left):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    monkeypatch.setattr(corpus_pipeline, "toxicity_model", lambda spark, d: toxicity.Model(prior=score))
    df = spark.createDataFrame([(i, "some text") for i in range(3)], "doc_id long, text string")
    assert corpus_pipeline.drop_toxic(spark, df, None).count() == left


def test_pipeline_against_plain_python(spark):
    """run() against one document at a time: scores, pairwise Jaccard, systematic sampling, the tokenizers library."""
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    tokenizers = pytest.importorskip("tokenizers")
    from lexivane.llm.queries import quality_model, tokenizer_path, toxicity_model

    d = "/root/testdata/sf0.001"
    docs = [r.asDict() for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    model = toxicity_model(spark, d)
    pair = model.open() if model.weights else None
    docs = [x for x in docs if model.scores([x["text"]], pair)[0][0] < 0.3]
    model = quality_model(spark, d)
    docs = [x for x in docs if model.scores(pa.array([x["text"]], pa.string()))[0] >= 0.3]
    sets, parent = [], list(range(len(docs)))
    for x in docs:
        w = words_of(x["text"])
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, x in enumerate(docs):
        least[root(i)] = min(x["doc_id"], least.get(root(i), x["doc_id"]))
    docs = [x for i, x in enumerate(docs) if least[root(i)] == x["doc_id"]]
    sizes = {}
    for x in docs:
        x["size"] = len(words_of(x["text"]))
        sizes[x["source"]] = sizes.get(x["source"], 0) + x["size"]
    target, want = brute_targets(sizes), []
    library = tokenizers.Tokenizer.from_file(tokenizer_path())
    for source in sizes:
        each = target[source] / sizes[source] if sizes[source] else 0
        u = int(hashlib.md5(f"20:{source or ''}".encode()).hexdigest()[:5], 16) / (1 << 20)
        for rank, x in enumerate(sorted((x for x in docs if x["source"] == source), key=lambda x: (x["size"], x["doc_id"])), 1):
            n = math.floor(rank * each + u) - math.floor((rank - 1) * each + u)
            ids = library.encode(x["text"] or "", add_special_tokens=False).ids
            want += [(x["doc_id"], str(source), ids, hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())] * n
    got = [(r.doc_id, str(r.source), list(r.ids), r.decoded_sha256) for r in corpus_pipeline.run(spark, d).collect()]
    assert 0 < len(want) and sorted(got) == sorted(want)


def test_pipeline_small(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    from lexivane.llm.common import table

    d = "/root/testdata/sf0.001"
    docs = table(spark, d, "documents")
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["drop_toxic", "keep_quality", "one_of_each_group", "mix_sources", "encode_bpe"]
    for _, f in corpus_pipeline.STAGES[:-1]:
        out = f(spark, docs, d)
        assert out.schema.simpleString() == docs.schema.simpleString()
        docs = spark.createDataFrame(out.collect(), out.schema)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, d)
    assert last.count() == docs.count() > 0
    empty = docs.limit(0)
    for _, f in corpus_pipeline.STAGES:
        assert f(spark, empty, d).count() == 0
