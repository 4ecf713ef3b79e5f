"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. A line's features (length, letter case, symbols, repetition,
punctuation and so on) and those of its two neighbours give its potential, and a pair of
neighbouring labels gives another; weights are fitted by the gradient of the conditional
likelihood. Labels are of documents: training starts from lines that carry their
document's label, then lines of bad documents that the model is sure are good are counted
as good (one line at least stays bad) and the model is fitted again. A document's quality is the
length-weighted mean of its lines' forward-backward marginals, put on the labels' scale by
a logistic curve.

Bounds: the fit reads at most MOST rows of either label of at most MOST_BYTES each,
chosen by the hash of their id among those whose text is no longer; scoring reads whole
texts, every line of them.

Defined results: null, empty and blank texts have no lines to judge and get score 0;
blank lines are not lines; labels that are null, not 0 or 1, or of unknown documents
aren't used; of repeated ids the least text is; with fewer than three texts of either label, or
no line in those that are learned from, every score is the share of good labels (0 without
labels); other columns are kept, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexivane.llm.bpe import slices
from lexivane.llm.common import bounded_batches, free_name, tidied
from lexivane.llm.shingles import word_hashes
from lexivane.llm.toxicity import labelled_texts, logistic

MOST, MOST_BYTES = 1500, 1 << 14
ROUNDS, RATE, RIDGE = 120, 0.15, 1e-3
THRESHOLD = 0.3
SURE = 0.9


def lines_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The lines of all texts that aren't blank, and the number of lines before each text and after the last."""
    split = pc.split_pattern(pc.fill_null(texts, ""), "\n")
    offsets, lines = np.asarray(split.offsets).astype(np.int64), split.values.slice(split.offsets[0].as_py(), split.offsets[-1].as_py() - split.offsets[0].as_py())
    offsets = offsets - offsets[0]
    some = np.asarray(pc.greater(pc.binary_length(pc.utf8_trim_whitespace(lines)), 0)) if len(lines) else np.zeros(0, bool)
    before = np.concatenate([[0], np.cumsum(some)])
    return lines.filter(pa.array(some)), before[offsets]


def _ratio(a, b):
    return np.asarray(a, np.float64) / np.maximum(1.0, np.asarray(b, np.float64))


def line_features(lines: pa.Array) -> np.ndarray:
    """One row of features per line, each about 0 to 1."""
    n = len(lines)
    if not n:
        return np.zeros((0, 16))
    chars = np.asarray(pc.utf8_length(lines)).astype(np.float64)
    count = lambda pattern: np.asarray(pc.count_substring_regex(lines, pattern))
    upper, other = count(r"\p{Lu}"), count(r"[^\p{L}\s]")
    mild = count(r"[.,;:'\"()\-]")
    bang, digit = count(r"[!]"), count(r"\p{Nd}")
    hashes, at = word_hashes(lines)
    words = np.diff(at).astype(np.float64)
    line = np.repeat(np.arange(n), np.diff(at))
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (line[1:] == line[:-1])
    order = np.lexsort((hashes, line))
    h, ln = hashes[order], line[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (ln[1:] != ln[:-1])
    distinct = np.bincount(ln[new], minlength=n)
    repeats = np.bincount(line[again], minlength=n)
    ends = np.asarray(pc.match_substring_regex(lines, r"[.!?…:;\"')\]]\s*$")).astype(np.float64)
    starts = np.asarray(pc.match_substring_regex(lines, r"^\s*\p{Ll}")).astype(np.float64)
    odd = _ratio(other - mild - bang - digit, chars)
    share = _ratio(distinct, words)
    return np.column_stack([
        np.minimum(1, np.log1p(chars) / 8),
        np.minimum(1, np.log1p(words) / 6),
        _ratio(upper, chars),
        (_ratio(upper, chars) > 0.3).astype(float),
        np.minimum(1, 4 * odd),
        (odd > 0.05).astype(float),
        np.minimum(1, 4 * _ratio(mild, chars)),
        np.minimum(1, 4 * _ratio(bang, chars)),
        np.minimum(1, 2 * _ratio(digit, chars)),
        _ratio(repeats, words),
        (_ratio(repeats, words) > 0.3).astype(float),
        np.where(words >= 8, 1 - share, 0),
        ((words >= 12) & (share < 0.4)).astype(float),
        np.minimum(1, _ratio(chars, words) / 20),
        ends,
        starts,
    ])


def with_neighbours(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Each line's features, a constant, those of the line before and after within its text, and whether there is one."""
    n, d = x.shape
    first, last = np.zeros(n, bool), np.zeros(n, bool)
    some = at[:-1] < at[1:]
    first[at[:-1][some]] = True
    last[at[1:][some] - 1] = True
    before, after = np.zeros((n, d)), np.zeros((n, d))
    if n:
        before[1:], after[:-1] = x[:-1], x[1:]
        before[first], after[last] = 0, 0
    return np.column_stack([np.ones(n), x, before, after, first, last])


def forward_backward(potential: np.ndarray, pair: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginal of good for each line, pair marginals summed per pair (2 x 2), and the log partition of each text.

    potential: of good against bad for each line; pair: 2 x 2, [before, after], 1 is good.
    All texts of one length or more are stepped together.
    """
    n, texts = len(potential), len(at) - 1
    sizes = np.diff(at)
    order = np.argsort(-sizes, kind="stable")
    start, size = at[:-1][order], sizes[order]
    alive = np.searchsorted(-size, -np.arange(1, int(size.max(initial=0)) + 1), "right").tolist()  # texts with so many lines
    a, b = np.zeros((n, 2)), np.zeros((n, 2))
    node = np.column_stack([np.zeros(n), potential])
    for t, k in enumerate(alive):
        i = start[:k] + t
        if t == 0:
            a[i] = node[i]
        else:
            p = a[i - 1]
            a[i] = np.logaddexp(p[:, :1] + pair[0], p[:, 1:] + pair[1]) + node[i]
    for t in range(len(alive) - 2, -1, -1):
        i = start[: alive[t + 1]] + t
        q = b[i + 1] + node[i + 1]
        b[i] = np.logaddexp(q[:, :1] + pair[:, 0], q[:, 1:] + pair[:, 1])
    last = at[1:] - 1
    some = sizes > 0
    z = np.zeros(texts)
    z[some] = np.logaddexp(a[last[some], 0], a[last[some], 1])
    owner = np.repeat(np.arange(texts), sizes)
    marginal = np.exp(np.clip(a[:, 1] + b[:, 1] - z[owner], -700, 0))
    inner = np.ones(n, bool)
    inner[at[:-1][some]] = False
    j = np.flatnonzero(inner)
    pairs = np.zeros((2, 2))
    for u in (0, 1):
        for v in (0, 1):
            pairs[u, v] = np.exp(np.clip(a[j - 1, u] + pair[u, v] + node[j, v] + b[j, v] - z[owner[j]], -700, 0)).sum()
    return marginal, pairs, z


@dataclass
class Model:
    weights: np.ndarray | None = None
    pair: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    curve: tuple[float, float] = (0.0, 1.0)
    prior: float = 0.0

    def marginals(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Marginal of good and length of each line, and the texts' bounds."""
        lines, at = lines_of(texts)
        x = with_neighbours(line_features(lines), at)
        m, _, _ = forward_backward(x @ self.weights, self.pair, at)
        return m, np.asarray(pc.utf8_length(lines)).astype(np.float64), at

    def raw(self, texts: pa.Array) -> np.ndarray:
        """Length-weighted mean marginal of each text; nan without lines."""
        m, chars, at = self.marginals(texts)
        owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
        total = np.bincount(owner, weights=chars, minlength=len(at) - 1)
        with np.errstate(invalid="ignore", divide="ignore"):
            return np.bincount(owner, weights=chars * m, minlength=len(at) - 1) / total

    def scores(self, texts: pa.Array) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), self.prior)
        s = self.raw(texts)
        z = self.curve[0] + self.curve[1] * _logit(np.nan_to_num(s))
        return np.where(np.isnan(s), 0.0, 1 / (1 + np.exp(-np.clip(z, -40, 40))))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-3, 1 - 1e-3)
    return np.log(p / (1 - p))


def _fit_chain(x: np.ndarray, y: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient ascent of the conditional log likelihood with a ridge, by Adam."""
    w, pair = np.zeros(x.shape[1]), np.zeros((2, 2))
    params = np.zeros(x.shape[1] + 4)
    m1, m2 = np.zeros_like(params), np.zeros_like(params)
    inner = np.ones(len(y), bool)
    inner[at[:-1][at[:-1] < at[1:]]] = False
    j = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[j - 1], y[j]), 1)
    for step in range(1, ROUNDS + 1):
        w, pair = params[:-4], params[-4:].reshape(2, 2)
        marginal, pairs, _ = forward_backward(x @ w, pair, at)
        g = np.concatenate([x.T @ (y - marginal), (seen - pairs).ravel()]) / len(y) - RIDGE * params
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        params = params + RATE * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
    return params[:-4], params[-4:].reshape(2, 2)


def train(good: list[str], bad: list[str], prior: float) -> Model:
    """Fit on two thirds of either kind, set the curve on the rest."""
    if len(good) < 3 or len(bad) < 3:
        return Model(prior=prior)
    cut_g, cut_b = len(good) * 2 // 3, len(bad) * 2 // 3
    texts = pa.array(good[:cut_g] + bad[:cut_b], pa.string())
    lines, at = lines_of(texts)
    if not len(lines):
        return Model(prior=prior)
    x = with_neighbours(line_features(lines), at)
    owner = np.repeat(np.arange(len(texts)), np.diff(at))
    y = (owner < cut_g).astype(np.int64)
    w, pair = _fit_chain(x, y, at)
    m, _, _ = forward_backward(x @ w, pair, at)
    sure = (owner >= cut_g) & (m > SURE)
    lowest = np.full(len(texts), np.inf)
    np.minimum.at(lowest, owner, m)
    y = np.where(sure & (m > lowest[owner]), 1, y)
    w, pair = _fit_chain(x, y, at)
    model = Model(weights=w, pair=pair, prior=prior)
    s = np.concatenate([model.raw(pa.array(good[cut_g:], pa.string())), model.raw(pa.array(bad[cut_b:], pa.string()))])
    label = np.array([1.0] * (len(good) - cut_g) + [0.0] * (len(bad) - cut_b))
    ok = ~np.isnan(s)
    s, label = _logit(s[ok]), label[ok]
    weight = np.where(label == 1, prior / max(1, label.sum()), (1 - prior) / max(1, (1 - label).sum()))
    curve = logistic(np.column_stack([np.ones(len(s)), s]), label, weight, 1e-3)
    model.curve = (float(curve[0]), max(1e-3, float(curve[1])))
    return model


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", key_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on a bounded sample of labels (key, label), which must hold only rows that may be learned from."""
    known = labels.select(F.col(key_col).alias("k"), F.col(label_col).cast("int").alias("y")).filter("k is not null and y in (0, 1)")
    counts = known.agg(F.sum("y").alias("p"), F.count("*").alias("n")).head()
    prior = float(counts.p or 0) / counts.n if counts.n else 0.0
    rows = labelled_texts(docs, known, key_col, text_col, 2, MOST_BYTES, {1: MOST, 0: MOST})
    return train([t for y, t in rows if y == 1], [t for y, t in rows if y == 0], prior)


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """docs with the score of each whole text."""
    score_col = free_name(docs, score_col)
    bounded_batches(docs.sparkSession)
    schema = T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())])

    def run(batches):
        for whole in batches:
            for batch in slices(whole, text_col, 1_000_000):
                found = model.scores(batch.column(batch.schema.get_field_index(text_col)))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], names=[*batch.schema.names, score_col])

    return docs.mapInArrow(tidied(run), schema)


def label_lines(docs: DataFrame, model: Model, key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per line that isn't blank: key, line number, line, marginal of good, label (1 good)."""
    bounded_batches(docs.sparkSession)
    slim = docs.select(F.col(key_col).alias("key"), F.col(text_col).alias("text"))
    key = slim.schema["key"].dataType.simpleString()

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text", 1_000_000):
                lines, at = lines_of(batch.column(1))
                m = model.marginals(batch.column(1))[0] if model.weights is not None else np.full(len(lines), model.prior)
                owner = np.repeat(np.arange(len(batch)), np.diff(at))
                number = np.arange(len(lines)) - at[:-1][owner]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner)), pa.array(number), lines, pa.array(m), pa.array((m >= 0.5).astype(np.int32))], names=["key", "line_no", "line", "marginal", "label"])

    return slim.mapInArrow(tidied(run), f"key {key}, line_no long, line string, marginal double, label int")
