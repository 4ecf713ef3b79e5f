"""Training of word vectors.

`auto` trains with Spark ML's skip-gram with hierarchical softmax where that is what is
asked for, and with the trainer of this module for the rest: continuous bag of words,
negative sampling and sentence vectors by the published algorithm. Without an objective (no
hierarchical softmax, no negative samples) there is nothing to train, and the vectors are
the seeded initial ones, as with `init`. The size of the corpus decides nothing.

Frequent words are dropped line by line, by draws that depend on the line, its id and the
seed alone; lines are rows, whatever their ids. Per iteration each of `threads` partitions
(fewer where that leaves less than LEAST_WORDS words to each) trains on its lines from the
weights that all start from, and the partitions' weights are averaged by the words that
they saw, so runs with the same seed and partitions agree. Lines are trained in a random
order, drawn like the words that are dropped (for lines without an id by their place too):
in the order of their words, weights would run after each stretch of like lines. The rate
falls over the words of a partition, whatever the batches that it comes in. A partition
trains on BATCH words at a time, fewer where there are less than four times as many
different ones: their windows are computed from the same weights.

Weights are a table of rows. A partition gets the rows that its lines can change and their
tree nodes (with negative samples every word's output), and gives back by how much it has
changed them; the driver sees none. Words, ids and tree are held by the driver and broadcast,
and Spark ML's trainer holds all weights in every task: that bounds the vocabulary, not the
corpus.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from dataclasses import dataclass, field
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.ml.feature import Word2Vec
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexivane.operators.cluster import classes as word_classes
from lexivane.operators.corpus import tokens_of
from lexivane.operators.model import VectorModel
from lexivane.operators.seeded import initial_vectors, vector_of
from lexivane.operators.vocab import build_vocab
from lexivane.storage import remove, shuffles_end_with_their_query, written

THREADS = 12
LEAST_WORDS = 20_000
BATCH = 64
#: Words of lines whose windows are laid out at a time, about.
PASS = 100_000


@dataclass
class Trained:
    """losses: the mean loss of each iteration by the module's own trainer, none for the others."""

    model: VectorModel
    vectors: DataFrame
    vocab: DataFrame
    classes: DataFrame | None = None
    losses: list[float] = field(default_factory=list)


def tree_paths(counts: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes and inner nodes of each word in a Huffman tree of the counts, ties by order, as rows of one width, and which of their places are real."""
    n = len(counts)
    if n < 2:
        return np.zeros((n, 1), np.int8), np.zeros((n, 1), np.int32), np.ones((n, 1), bool)
    heap = [(c, i) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    parent, code = np.zeros(2 * n - 1, np.int32), np.zeros(2 * n - 1, np.int8)
    for nxt in range(n, 2 * n - 1):
        c1, a = heapq.heappop(heap)
        c2, b = heapq.heappop(heap)
        parent[a] = parent[b] = nxt
        code[b] = 1
        heapq.heappush(heap, (c1 + c2, nxt))
    top, ups = 2 * n - 2, [np.arange(n)]
    while (ups[-1] != top).any():
        ups.append(np.where(ups[-1] == top, top, parent[ups[-1]]))
    depth = sum((u != top).astype(np.int64) for u in ups)
    wide = len(ups) - 1
    codes, points, real = np.zeros((n, wide), np.int8), np.zeros((n, wide), np.int32), np.zeros((n, wide), bool)
    for up, u in enumerate(ups[:-1]):
        some = np.flatnonzero(u != top)
        at = depth[some] - 1 - up
        codes[some, at], points[some, at], real[some, at] = code[u[some]], parent[u[some]] - n, True
    return codes, points, real


def huffman(counts: list[int]) -> tuple[list[list[int]], list[list[int]]]:
    """Codes and inner nodes of each word in a Huffman tree of the counts, ties by order."""
    codes, points, real = tree_paths(counts)
    return tuple([row[some].tolist() for row, some in zip(x, real)] for x in (codes, points))


def keep_chances(counts: np.ndarray, t: float) -> np.ndarray:
    """How likely an occurrence of each word stays: (sqrt(f/t) + 1) * t / f, at most 1."""
    if t <= 0:
        return np.ones(len(counts))
    f = np.maximum(counts, 1) / max(1, counts.sum())
    return np.minimum(1.0, (np.sqrt(f / t) + 1) * t / f)


def subsampled(corpus: DataFrame, vocab: list, t: float, seed: int = 1) -> DataFrame:
    """words, and ids (places in the vocabulary), of each line with words that aren't in the vocabulary left out and frequent ones dropped at random, and the line's place in a random order (turn); one narrow stage."""
    known = {r.word: i for i, r in enumerate(vocab)}
    sent = corpus.sparkSession.sparkContext.broadcast((known, keep_chances(np.array([r["count"] for r in vocab], np.float64), t)))

    def run(frames):
        at, keep = sent.value
        part = TaskContext.get().partitionId()
        for k, pdf in enumerate(frames):
            words, found, turns, copies = [], [], [], Counter()
            for doc, tokens in zip(pdf["doc"], pdf["tokens"]):
                tokens = [] if tokens is None else list(tokens)
                names = [w for w in tokens if w in at]
                have = np.array([at[w] for w in names], np.int64)
                mark = zlib.crc32(f"{doc} {' '.join(tokens)}".encode())
                stay = np.random.default_rng([seed, mark]).random(len(have)) < keep[have]
                words.append([w for w, x in zip(names, stay) if x])
                found.append(have[stay].astype(np.int32))
                # Copies that no id tells apart mustn't be trained in a row.
                turns.append(int.from_bytes(blake2b(f"{seed} {mark} {copies[mark]} {'' if doc else (part, k)}".encode(), digest_size=8).digest(), "little", signed=True))
                copies[mark] += 1
            yield pd.DataFrame({"words": words, "ids": found, "turn": turns})

    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc")
    return corpus.select(doc, tokens_of(F.col("line")).alias("tokens")).mapInPandas(run, "words array<string>, ids array<int>, turn long")


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def windows(lines: list[np.ndarray], window: int, rng: np.random.Generator, docs: frozenset = frozenset()) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words of the lines in a row, and the (place, context word) pairs of their shrunk windows; a line's document word is in every window of it."""
    words = np.concatenate([*lines, np.zeros(0, np.int64)]).astype(np.int64)
    n = len(words)
    line = np.repeat(np.arange(len(lines)), [len(x) for x in lines])
    reach = window - rng.integers(0, max(1, window), n)
    places, contexts = [], []
    for d in range(1, window + 1):
        if d >= n:
            break
        near = line[d:] == line[:-d]
        right, left = np.flatnonzero(near & (reach[:-d] >= d)), np.flatnonzero(near & (reach[d:] >= d))
        places += [right, left + d]
        contexts += [words[right + d], words[left]]
    if docs:
        first = np.array([x[0] if len(x) and int(x[0]) in docs else -1 for x in lines], np.int64)[line]
        begins = np.concatenate([[0], np.cumsum([len(x) for x in lines])[:-1]])[line] if n else np.zeros(0, np.int64)
        # Not for the document word itself, nor where the window has it already.
        some = np.flatnonzero((first >= 0) & (words != first) & (np.arange(n) - begins > reach))
        places.append(some)
        contexts.append(first[some])
    place, context = (np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64) for x in (places, contexts))
    order = np.argsort(place, kind="stable")
    return words, place[order], context[order]


def _add(into: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """into[rows] += values, where rows may repeat."""
    order = np.argsort(rows, kind="stable")
    rows = rows[order]
    first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]])[: len(rows)])
    if len(first):
        into[rows[first]] += np.add.reduceat(values[order], first, axis=0)


def step(weights: np.ndarray, outputs: np.ndarray, sources: np.ndarray, owner: np.ndarray, targets: np.ndarray, settings: dict, alpha: float, rng: np.random.Generator) -> tuple[float, int]:
    """One update: example k has the mean of the weights of the sources that owner gives it, and is to tell targets[k]. Loss and examples."""
    n = len(targets)
    share = np.bincount(owner, minlength=n)
    h = np.zeros((n, weights.shape[1]))
    _add(h, owner, weights[sources])
    h /= np.maximum(1, share)[:, None]
    nodes, labels, real = [], [], []
    if settings["hs"]:
        nodes.append(settings["points"][targets])
        labels.append(1.0 - settings["codes"][targets])
        real.append(settings["paths"][targets])
    if settings["negative"]:
        drawn = settings["table"][rng.integers(0, len(settings["table"]), (n, settings["negative"]))]
        told = settings["places"][targets]
        nodes.append(settings["inner"] + np.column_stack([told, drawn]))
        labels.append(np.column_stack([np.ones(n), np.zeros(drawn.shape)]))
        real.append(np.column_stack([np.ones(n, bool), drawn != told[:, None]]))
    node, y, use = (np.concatenate(x, axis=1) for x in (nodes, labels, real))
    theta = outputs[node]
    p = _sigmoid(np.einsum("nts,ns->nt", theta, h))
    loss = -float((np.log(np.where(y > 0, p, 1 - p) + 1e-12) * use).sum())
    g = (y - p) * use * alpha
    error = np.einsum("nt,nts->ns", g, theta)
    _add(outputs, node[use], g[use][:, None] * np.repeat(h, use.sum(1), axis=0))
    _add(weights, sources, error[owner])
    return loss, n


def train_lines(lines: list[np.ndarray], weights: np.ndarray, outputs: np.ndarray, settings: dict, rate: tuple[float, float], rng: np.random.Generator) -> tuple[int, float]:
    """One pass over lines of word ids, changing both weight matrices: words trained and mean loss."""
    words, place, context = windows(lines, settings["window"], rng, settings["doc_ids"])
    n, loss, examples = len(words), 0.0, 0
    if not settings["hs"] and not settings["negative"]:
        return n, 0.0
    batch = settings["batch"]
    for start in range(0, n, batch):
        a, b = np.searchsorted(place, [start, start + batch])
        if a == b:
            continue
        alpha = max(rate[0] + (rate[1] - rate[0]) * start / n, settings["alpha"] * 1e-4)
        if settings["cbow"]:
            at, owner = np.unique(place[a:b], return_inverse=True)
            found = step(weights, outputs, context[a:b], owner, words[at], settings, alpha, rng)
        else:
            found = step(weights, outputs, context[a:b], np.arange(b - a), words[place[a:b]], settings, alpha, rng)
        loss, examples = loss + found[0], examples + found[1]
    return n, loss / max(1, examples)


def train(corpus: DataFrame, size: int = 100, window: int = 5, sample: float = 1e-3, hs: int = 1, negative: int = 0, cbow: int = 0, iter: int = 5, min_count: int = 5, alpha: float | None = None, threads: int = THREADS, classes: int = 0, sentence_vectors: bool = False, vocab: DataFrame | None = None, mode: str = "auto", seed: int = 1, decimals: int | None = None, partitions: int | None = None) -> Trained:
    """Vectors of the words of a corpus (doc_id, line). mode: auto, init, ml or own. threads: how many partitions train side by side, unless partitions says so."""
    if alpha is None:
        alpha = 0.05 if cbow else 0.025
    if sentence_vectors:
        min_count = 1
    vocab = build_vocab(corpus, min_count) if vocab is None else vocab
    losses: list[float] = []
    if mode == "auto":
        mode = "init" if not hs and not negative else "ml" if hs and not negative and not cbow and not sentence_vectors else "own"
    if mode == "init":
        vectors = initial_vectors(vocab, size, decimals)
    elif mode in ("ml", "own"):
        vocab = written(vocab)
        rows = vocab.orderBy("word_id").collect()  # every task holds the whole vocabulary's weights, so the driver can hold its words
        lines = written(subsampled(corpus, rows, sample, seed))  # read once and settled
        n_words = lines.agg(F.sum(F.size("ids")).alias("n")).head().n or 0
        k = partitions or max(1, min(threads, int(n_words // LEAST_WORDS)))
        if mode == "ml":
            fitted = Word2Vec(vectorSize=size, windowSize=window, minCount=1, stepSize=alpha, maxIter=iter, numPartitions=k, seed=seed, inputCol="words", outputCol="out").fit(lines.select("words"))
            from pyspark.ml.functions import vector_to_array

            learned = fitted.getVectors().select("word", vector_to_array("vector").cast("array<float>").alias("learned"))
            start = initial_vectors(vocab, size)
            vectors = start.join(learned, "word", "left").select("word_id", "word", F.coalesce("learned", "vector").alias("vector"))
        else:
            vectors, losses = _own(lines, vocab, rows, size, window, hs, negative, cbow, iter, alpha, sentence_vectors, seed, k)
        remove(lines)
    else:
        raise ValueError(f"unknown mode: {mode}")
    model = VectorModel.from_vectors(vectors, size)
    return Trained(model, vectors, vocab, word_classes(model.df, classes) if classes > 0 else None, losses)


class Share:
    """One pass of a partition over its lines, with the rows of the weights that they need: rows come by side (0 weights, 1 outputs) and number, then lines by turn."""

    def __init__(self, settings: dict, part: int, turn: int):
        self.settings, self.rng = settings, np.random.default_rng([settings["seed"], turn, part])
        self.rates = [settings["alpha"] * max(1e-4, 1 - (turn + e) / settings["iter"]) for e in (0, 1)]
        self.part, self.words = part, settings["sizes"][part]
        self.rows, self.values, self.parts = ([], []), ([], []), ([], [])
        self.lines, self.held, self.seen, self.loss = [], 0, 0, 0.0
        self.start = None

    def take(self, pdf: pd.DataFrame) -> None:
        sides = pdf["side"].to_numpy()
        for side in (0, 1):
            some = np.flatnonzero(sides == side)
            if len(some):
                self.rows[side].append(pdf["row"].to_numpy()[some])
                self.values[side].append(np.frombuffer(b"".join(pdf["vector"].iloc[some])))
                self.parts[side].extend(pdf["parts"].iloc[some])
        for ids in pdf["ids"].iloc[np.flatnonzero(sides == 2)]:
            if self.start is None:
                self.open()
            self.lines.append(np.searchsorted(self.rows[0], ids))
            self.held += len(ids)
            if self.held >= PASS:
                self.go()

    def open(self) -> None:
        s = self.settings
        self.rows = [np.concatenate([*x, np.zeros(0, np.int64)]) for x in self.rows]
        self.start = [np.concatenate([*x, np.zeros(0)]).reshape(-1, s["size"]) for x in self.values]
        self.values = [x.copy() for x in self.start]
        words, nodes = self.rows
        real = s["paths"][words]
        self.local = s | {"places": words, "inner": len(nodes) - s["n"] if s["negative"] else 0, "doc_ids": frozenset(np.flatnonzero(s["is_doc"][words]).tolist())}
        self.local |= {"codes": s["codes"][words], "points": np.where(real, np.searchsorted(nodes, s["points"][words]), 0), "paths": real}

    def go(self) -> None:
        share = [(self.seen + n) / max(1, self.words) for n in (0, self.held)]
        m, mean = train_lines(self.lines, *self.values, self.local, tuple(self.rates[0] + (self.rates[1] - self.rates[0]) * x for x in share), self.rng)
        self.seen, self.loss = self.seen + m, self.loss + m * mean
        self.lines, self.held = [], 0

    def close(self):
        """By how much its part of all words has changed each row; the first partition that has a row gives what it was besides."""
        if self.start is None:
            return
        self.go()
        part_of_all = self.seen / self.settings["total"]
        for side in (0, 1):
            owner = np.array([x is not None for x in self.parts[side]], bool)
            give = owner | (self.values[side] != self.start[side]).any(axis=1)
            give[:1] |= side == 0  # has the loss
            for some in np.array_split(np.flatnonzero(give), 1 + int(give.sum()) // 2000) if give.any() else ():
                start = self.start[side][some]
                out = (self.values[side][some] - start) * part_of_all + start * owner[some][:, None]
                lost = np.where((some == 0) & (side == 0), self.loss, 0.0)
                yield pd.DataFrame({"side": side, "row": self.rows[side][some], "part": self.part, "parts": pd.Series([self.parts[side][i] for i in some], dtype=object), "lost": lost, "vector": [x.tobytes() for x in out]})


def summed(frames):
    """The rows of partitions that stand for one row of the weights, in order and side by side, as one."""
    held = None
    for pdf in frames:
        if held is not None:
            pdf = pd.concat([held, pdf], ignore_index=True)
        side, row = pdf["side"].to_numpy(), pdf["row"].to_numpy()
        new = np.flatnonzero(np.concatenate([[True], (side[1:] != side[:-1]) | (row[1:] != row[:-1])])[: len(pdf)])
        if len(new) < 2:
            held = pdf
            continue
        held = pdf.iloc[new[-1] :]
        yield _one_each(pdf.iloc[: new[-1]], new[:-1])
    if held is not None and len(held):
        yield _one_each(held, np.zeros(1, np.int64))


def _one_each(pdf: pd.DataFrame, new: np.ndarray) -> pd.DataFrame:
    vectors = np.frombuffer(b"".join(pdf["vector"])).reshape(len(pdf), -1)
    sizes = np.diff(np.concatenate([new, [len(pdf)]]))
    out, lost = vectors[new], pdf["lost"].to_numpy()[new]
    for j in range(1, sizes.max(initial=0)):  # one after the other, so that batches decide nothing
        some = np.flatnonzero(sizes > j)
        out[some] += vectors[new[some] + j]
        lost[some] += pdf["lost"].to_numpy()[new[some] + j]
    return pd.DataFrame({"side": pdf["side"].iloc[new], "row": pdf["row"].iloc[new], "parts": pdf["parts"].iloc[new], "lost": lost, "vector": [x.tobytes() for x in out]})


def _own(lines: DataFrame, vocab: DataFrame, rows: list, size, window, hs, negative, cbow, iter, alpha, sentence_vectors, seed, k) -> tuple[DataFrame, list[float]]:
    spark = lines.sparkSession
    n, counts = len(rows), [r["count"] for r in rows]
    inner = max(1, n - 1) if hs else 0
    codes, points, paths = tree_paths(counts) if hs else (np.zeros((n, 0), np.int8), np.zeros((n, 0), np.int32), np.zeros((n, 0), bool))
    power = np.array(counts, dtype=np.float64) ** 0.75
    table = np.repeat(np.arange(n), np.maximum(1, (power / power.sum() * 100_000).astype(int))) if negative else np.zeros(1, int)
    is_doc = np.array([sentence_vectors and r.word.startswith("doc_id:") for r in rows], bool)
    # Dealt by each line's turn, so that partitions are random, and the same in each run.
    dealt = lines.select(F.pmod(F.hash("turn"), F.lit(k)).alias("part"), "turn", "ids").filter(F.size("ids") > 0)
    sizes = {r.part: r.n for r in dealt.groupBy("part").agg(F.sum(F.size("ids")).alias("n")).collect()}
    settings = {"cbow": cbow, "hs": hs, "negative": negative, "window": window, "codes": codes, "points": points, "paths": paths, "table": table, "is_doc": is_doc, "alpha": alpha, "iter": iter, "seed": seed, "size": size, "n": n}
    settings |= {"word_ids": np.array([r.word_id for r in rows], np.int64), "sizes": sizes, "total": sum(sizes.values()), "batch": max(1, min(BATCH, n // 4))}
    sent = spark.sparkContext.broadcast(settings)

    def needed(frames):
        seen = {}
        for pdf in frames:
            for part, ids in pdf.groupby("part")["ids"]:
                seen.setdefault(part, np.zeros(n, bool))[np.concatenate(list(ids))] = True
        s = sent.value
        for part, some in seen.items():
            words = np.flatnonzero(some)
            nodes = np.unique(s["points"][words][s["paths"][words]])
            if negative:
                nodes = np.concatenate([nodes, inner + np.arange(n)])
            yield pd.DataFrame({"part": part, "side": np.repeat([0, 1], [len(words), len(nodes)]), "row": np.concatenate([words, nodes])})

    def begun(frames):
        for pdf in frames:
            ids = sent.value["word_ids"][np.where(pdf["side"] == 0, pdf["row"], 0)]
            yield pdf.assign(lost=0.0, vector=[(vector_of(i, size) if side == 0 else np.zeros(size)).tobytes() for i, side in zip(ids, pdf["side"])])

    def run(frames, turn):
        share = None
        for pdf in frames:
            for part, some in pdf.groupby("part", sort=False):
                if share is None or share.part != part:
                    if share is not None:
                        yield from share.close()
                    share = Share(sent.value, part, turn)
                share.take(some)
        if share is not None:
            yield from share.close()

    kept = "side int, row long, parts array<int>, lost double, vector binary"
    losses = []
    with shuffles_end_with_their_query(spark):
        wanted = dealt.mapInPandas(needed, "part int, side int, row long").groupBy("side", "row").agg(F.array_sort(F.collect_set("part")).alias("parts"))
        state = written(wanted.mapInPandas(begun, kept))
        for turn in range(iter if sizes else 0):
            to = state.select(F.explode("parts").alias("part"), "side", "row", "parts", "vector").withColumn("parts", F.when(F.col("part") == F.col("parts")[0], F.col("parts")))
            fed = to.withColumn("ids", F.lit(None).cast("array<int>")).unionByName(dealt.select("part", F.lit(2).alias("side"), F.col("turn").alias("row"), "ids"), allowMissingColumns=True)
            fed = fed.repartitionById(k, "part").sortWithinPartitions("part", "side", "row", "ids")
            changed = fed.mapInPandas(lambda frames, turn=turn: run(frames, turn), kept.replace("parts", "part int, parts", 1))
            old, state = state, written(changed.repartition("side", "row").sortWithinPartitions("side", "row", "part").mapInPandas(summed, kept))
            remove(old)
            losses.append(sum(r.lost for r in state.filter("lost != 0").orderBy("side", "row").select("lost").collect()) / settings["total"])

        def learned(frames):
            for pdf in frames:
                yield pd.DataFrame({"word_id": sent.value["word_ids"][pdf["row"]], "learned": [np.frombuffer(x).astype(np.float32) for x in pdf["vector"]]})

        found = state.filter("side = 0").mapInPandas(learned, "word_id int, learned array<float>")
        vectors = written(initial_vectors(vocab, size).join(found, "word_id", "left").select("word_id", "word", F.coalesce("learned", "vector").alias("vector")))
    remove(state)
    sent.destroy()
    return vectors, losses
