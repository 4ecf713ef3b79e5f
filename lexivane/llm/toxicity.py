"""Toxicity by compression distance.

Two zstandard dictionaries are trained from labelled texts, one on windows of words of
ordinary texts and one on windows of toxic texts. As most of a toxic text is ordinary, the
toxic training windows are found by the same distance: BAGS pairs of dictionaries are
trained on random halves of either kind, and a window of a toxic text stays if the pairs
that didn't see its text save more on it than on nearly all (KEPT) windows of ordinary
texts that none of them saw. The final toxic dictionary is trained on the windows that
stayed. A compressor for the toxic side gets the toxic dictionary's content before the
ordinary one's, and both sides have the ordinary dictionary's entropy tables, so that the
two lengths of a window differ by matches in the toxic content alone.

Each whole text is cut into overlapping windows; a window is compressed with either
dictionary, and the bytes that the toxic one saves are its distance. Thresholds on windows
come from the distances in ordinary texts that no dictionary saw, and a logistic curve
over the number and share of windows above them, the largest distances and the mean makes
the text's score, calibrated to the labels' prior.

Bounds: the fit reads at most MOST_TOXIC + MOST_ORDINARY labelled rows of at most
MOST_BYTES each, chosen by the hash of their id among those whose text is no longer;
scoring reads whole texts.

Defined results: null and empty texts have no windows and get the score that the curve
gives to no distance; labels that are null, not 0 or 1, or of unknown documents aren't
used; of repeated ids the least text is. Where no pair of dictionaries can be trained, that
is without three different texts of either kind at least or with less text than zstandard's
trainer accepts (some hundreds of bytes), every score is the share of toxic labels, 0
without labels. Words of over LONGEST bytes are cut into pieces of that size; other
columns are kept, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import struct
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexivane.llm.bpe import slices
from lexivane.llm.common import bounded_batches, free_name, materialize, scratch, tidied

MOST_TOXIC, MOST_ORDINARY, MOST_BYTES = 4000, 4000, 1 << 15
ORDINARY_BYTES, BAG_BYTES, TOXIC_BYTES = 65536, 8192, 4096
#: Windows that are scored; windows that are judged for the toxic dictionary.
WINDOW, STRIDE = 8, 4
SHORT, STEP = 4, 2
BAGS, KEPT = 6, 0.9995
#: Segments of so many bytes are chosen by how often their runs of so many bytes occur.
TRAINER = {"k": 16, "d": 6, "level": 6}
QUANTILES = (0.98, 0.99, 0.998, 0.9995)
SEED = 1
#: Lazy search in binary trees, with tables sized for windows and dictionaries: steady lengths and little memory.
SEARCH = {"strategy": zstd.STRATEGY_BTLAZY2, "window_log": 17, "hash_log": 15, "chain_log": 16, "search_log": 6, "min_match": 3, "target_length": 64}
LONGEST = 64
THRESHOLD = 0.3
#: The repeat offsets that end a trained dictionary's tables (fixed values of the format).
_OFFSETS = struct.pack("<3I", 1, 4, 8)

_words = re.compile(rb"[^\x20\x09-\x0D]{1,%d}" % LONGEST)


def words_of(text: str | None) -> list[bytes]:
    return _words.findall((text or "").lower().encode("utf-8", "surrogatepass"))


def windows(words: list[bytes], size: int = WINDOW, step: int = STRIDE) -> list[bytes]:
    n = len(words)
    return [b" " + b" ".join(words[i : i + size]) + b" " for i in range(0, max(n - size + step, min(n, 1)), step)]


def compressor(dictionary: bytes):
    """The compressing function of a trained dictionary; frames have no more than their blocks need."""
    params = zstd.ZstdCompressionParameters(**SEARCH, format=zstd.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False)
    d = zstd.ZstdCompressionDict(dictionary, dict_type=zstd.DICT_TYPE_FULLDICT)
    d.precompute_compress(compression_params=params)
    return zstd.ZstdCompressor(dict_data=d, compression_params=params).compress


def trained(size: int, samples: list[bytes]) -> bytes:
    """A dictionary of at most so many bytes, and of at most a quarter of the samples."""
    return zstd.train_dictionary(min(size, max(256, sum(map(len, samples)) // 4)), samples, **TRAINER).as_bytes()


def parts_of(dictionary: bytes) -> tuple[bytes, bytes]:
    """A trained dictionary's tables and its content."""
    at = dictionary.index(_OFFSETS) + len(_OFFSETS)
    return dictionary[:at], dictionary[at:]


def beside(toxic: bytes, ordinary: bytes) -> bytes:
    """The toxic side's dictionary: toxic content before the ordinary dictionary's, under the tables of the latter."""
    tables, content = parts_of(ordinary)
    return tables + parts_of(toxic)[1] + content


def lengths(compress, found: list[bytes]) -> np.ndarray:
    return np.array([len(compress(w)) for w in found], dtype=np.float64)


@dataclass
class Model:
    ordinary: bytes = b""
    toxic: bytes = b""
    limits: tuple[float, ...] = (1.0,)
    centre: list[float] = field(default_factory=list)
    spread: list[float] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    prior: float = 0.0

    def open(self):
        """Compressors aren't sent to executors; each makes its own."""
        return compressor(self.ordinary), compressor(beside(self.toxic, self.ordinary))

    def distances(self, text: str | None, pair) -> np.ndarray:
        a, b = pair
        return np.array([len(a(w)) - len(b(w)) for w in windows(words_of(text))], dtype=np.float64)

    def features(self, found: list[np.ndarray]) -> np.ndarray:
        """One row for the distances of each text; zeros for a text without windows."""
        sizes = np.array([len(d) for d in found])
        out = np.zeros((len(found), 3 + 2 * len(self.limits)))
        some = np.flatnonzero(sizes)
        if not len(some):
            return out
        n, flat = sizes[some], np.concatenate([found[i] for i in some])
        starts = np.concatenate([[0], np.cumsum(n)[:-1]])
        owner = np.repeat(np.arange(len(n)), n)
        ranked = flat[np.lexsort((-flat, owner))]
        place = np.arange(len(flat)) - starts[owner]
        out[some, 0] = ranked[starts]
        out[some, 1] = np.bincount(owner, weights=np.where(place < 3, ranked, 0)) / np.minimum(n, 3)
        out[some, 2] = np.bincount(owner, weights=flat) / n
        for k, limit in enumerate(self.limits):
            over = np.bincount(owner, weights=flat >= limit)
            out[some, 3 + 2 * k], out[some, 4 + 2 * k] = np.sqrt(over), over / n
        return out

    def scores(self, texts: list[str | None], pair) -> tuple[np.ndarray, np.ndarray]:
        """Score and largest distance of each text."""
        if not self.weights:
            return np.full(len(texts), self.prior), np.zeros(len(texts))
        x = self.features([self.distances(t, pair) for t in texts])
        z = self.weights[0] + ((x - self.centre) / self.spread) @ np.array(self.weights[1:])
        return 1 / (1 + np.exp(-np.clip(z, -40, 40))), x[:, 0]


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Newton's method with a ridge on all but the first weight."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    total = weight.sum()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (p - y)) / total + penalty * w
        h = (x.T * (weight * p * (1 - p) / total)) @ x + np.diag(penalty)
        step = np.linalg.solve(h, g)
        w = w - step
        if np.abs(step).max() < 1e-7:
            break
    return w


def _first_of_copies(texts: list[str]) -> list[str]:
    """Texts but those that share a least or second least word triple with one before: near-copies would count a chance passage many times."""
    seen, out = set(), []
    for t in texts:
        w = words_of(t)
        marks = sorted({hashlib.blake2b(b" ".join(w[i : i + 3]), digest_size=8).digest() for i in range(max(1, len(w) - 2))})[:2]
        if not any(m in seen for m in marks):
            out.append(t)
        seen.update(marks)
    return out


def toxic_windows(toxic: list[list[bytes]], apart: list[list[bytes]], ordinary: bytes, rng: np.random.Generator) -> list[bytes]:
    """The windows of toxic texts on which dictionaries of other toxic texts save more than on nearly all windows of ordinary texts."""
    plain = compressor(ordinary)
    whole = [windows(t, WINDOW, WINDOW) for t in toxic]
    short = [windows(t, SHORT, STEP) for t in toxic]
    other = [w for t in apart for w in windows(t, SHORT, STEP)]
    saved, seen, other_saved = [np.zeros(len(w)) for w in short], np.zeros(len(toxic)), np.zeros(len(other))
    base, other_base = [lengths(plain, w) for w in short], lengths(plain, other)
    for _ in range(BAGS):
        inside = rng.permutation(len(toxic)) < len(toxic) / 2
        bag = compressor(beside(trained(BAG_BYTES, [w for i in np.flatnonzero(inside) for w in whole[i]]), ordinary))
        other_saved += (other_base - lengths(bag, other)) / BAGS
        for i in np.flatnonzero(~inside):
            saved[i] += base[i] - lengths(bag, short[i])
            seen[i] += 1
    limit = max(0.0, float(np.quantile(other_saved, KEPT)))
    return [w for i, found in enumerate(short) if seen[i] for w, s in zip(found, saved[i] / seen[i]) if s > limit]


def train(toxic: list[str], ordinary: list[str], prior: float) -> Model:
    """Dictionaries from two thirds of either kind, thresholds and curve from the rest."""
    toxic, ordinary = [words_of(t) for t in _first_of_copies(toxic)], [words_of(t) for t in _first_of_copies(ordinary)]
    if len(toxic) < 3 or len(ordinary) < 3:
        return Model(prior=prior)
    cut_t, cut_o = len(toxic) * 2 // 3, len(ordinary) * 2 // 3
    rng = np.random.default_rng(SEED)
    try:
        base = trained(ORDINARY_BYTES, [w for t in ordinary[:cut_o] for w in windows(t, WINDOW, WINDOW)])
        own = trained(TOXIC_BYTES, toxic_windows(toxic[:cut_t], ordinary[cut_o : cut_o + 1000], base, rng))
    except zstd.ZstdError:
        return Model(prior=prior)
    model = Model(ordinary=base, toxic=own, prior=prior)
    a, b = model.open()
    found = [lengths(a, w) - lengths(b, w) for t in [*toxic[cut_t:], *ordinary[cut_o:]] for w in [windows(t)]]
    every = np.concatenate([*found[len(toxic) - cut_t :], np.zeros(1)])
    model.limits = tuple(sorted({max(1.0, float(np.quantile(every, q))) for q in QUANTILES}))
    x = model.features(found)
    y = np.array([1.0] * (len(toxic) - cut_t) + [0.0] * (len(ordinary) - cut_o))
    weight = np.where(y == 1, prior / y.sum(), (1 - prior) / (1 - y).sum())
    model.centre, model.spread = x.mean(0).tolist(), (x.std(0) + 1e-6).tolist()
    model.weights = logistic(np.column_stack([np.ones(len(x)), (x - model.centre) / model.spread]), y, weight, 1e-3).tolist()
    return model


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", key_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on a bounded sample of labels (key, label), which must hold only rows that may be learned from."""
    known = labels.select(F.col(key_col).alias("k"), F.col(label_col).cast("int").alias("y")).filter("k is not null and y in (0, 1)")
    counts = known.agg(F.sum("y").alias("p"), F.count("*").alias("n")).head()
    prior = float(counts.p or 0) / counts.n if counts.n else 0.0
    rows = labelled_texts(docs, known, key_col, text_col, 1, MOST_BYTES, {1: MOST_TOXIC, 0: MOST_ORDINARY})
    return train([t for y, t in rows if y == 1], [t for y, t in rows if y == 0], prior)


def labelled_texts(docs: DataFrame, known: DataFrame, key_col: str, text_col: str, salt: int, most_bytes: int, most: dict[int, int]) -> list[tuple[int, str]]:
    """Label and text of a bounded choice by the hash of the id: `most` of either label, twice as many asked for, so that those passed over as too long are made up for."""
    order = F.xxhash64(F.col("k"), F.lit(salt))
    picked = None
    for y, n in most.items():
        some = known.filter(F.col("y") == y).orderBy(order, "k").limit(2 * n)
        picked = some if picked is None else picked.unionByName(some)
    texts = docs.select(F.col(key_col).alias("k"), F.col(text_col).alias("t")).filter(F.octet_length("t") <= most_bytes)
    with scratch(docs.sparkSession):
        # Written, so that the documents are read once for all labels.
        found = materialize(texts.join(F.broadcast(picked), "k").groupBy("k", "y").agg(F.min("t").alias("t")), "labelled")
        kept = None
        for y, n in most.items():
            some = found.filter(F.col("y") == y).orderBy(order, "k").limit(n)
            kept = some if kept is None else kept.unionByName(some)
        rows = kept.toArrow().to_pylist()
    rows.sort(key=lambda r: (hashlib.blake2b(str(r["k"]).encode(), digest_size=8).digest(), r["y"]))
    return [(r["y"], r["t"]) for r in rows]


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score", distance_col: str = "largest_distance") -> DataFrame:
    """docs with the score of each whole text and its largest window distance."""
    score_col, distance_col = free_name(docs, score_col), free_name(docs, distance_col)
    bounded_batches(docs.sparkSession)
    schema = T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType()), T.StructField(distance_col, T.DoubleType())])

    def run(batches):
        pair = model.open() if model.weights else None
        for whole in batches:
            for batch in slices(whole, text_col, 1_000_000):
                found = model.scores(batch.column(batch.schema.get_field_index(text_col)).to_pylist(), pair)
                yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(x, pa.float64()) for x in found)], names=[*batch.schema.names, score_col, distance_col])

    return docs.mapInArrow(tidied(run), schema)
