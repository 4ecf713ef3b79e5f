"""Word-shingle sets and fast similarity sketches over Arrow batches, vectorised with NumPy.

Words are hashed by BLAKE2b, each distinct word of a batch once; a shingle's hash chains
the hashes of its words through a 64-bit finalizer, so that no structure of the words
shows in it. Two different shingles agree with probability 2^-64. For texts whose writers
may look for equal hashes (2^32 trials), `key` keeps the hashes from them.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORDS = 5
KEY = b""


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finalizer, salted."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((salt * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: pa.Array, key: bytes = KEY) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word [^\\x20\\x09-\\x0D]+ (A-Z lower-cased) of all texts in a row, and the number of words before each text and after the last. Null texts have none."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    offsets = np.asarray(split.offsets).astype(np.int64)
    words = split.values.slice(offsets[0], offsets[-1] - offsets[0])
    offsets = offsets - offsets[0]
    some = np.asarray(pc.binary_length(words)) > 0 if len(words) else np.zeros(0, bool)
    before = np.concatenate([[0], np.cumsum(some)]).astype(np.int64)
    coded = words.filter(pa.array(some)).dictionary_encode()
    distinct = coded.dictionary.cast(pa.large_binary() if pa.types.is_large_string(coded.dictionary.type) else pa.binary()).to_numpy(zero_copy_only=False).tolist()
    hashes = np.frombuffer(b"".join([blake2b(w, digest_size=8, key=key).digest() for w in distinct]), np.uint64)
    return hashes[np.asarray(coded.indices)], before[offsets]


def _chained(parts: list[np.ndarray]) -> np.ndarray:
    """One hash of the hashes of some words in a row, and of their number."""
    out = np.full(len(parts[0]), len(parts), np.uint64)
    for part in parts:
        out = mix(mix(out, 5) ^ part, 6)
    return out


def shingle_sets(texts: pa.Array, words: int = WORDS, key: bytes = KEY) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text with fewer words has its whole sequence as one, one without words none."""
    h, at = word_hashes(texts, key)
    if not len(h):
        return [np.zeros(0, np.uint64)] * len(texts)
    n = max(0, len(h) - words + 1)
    all_of = _chained([h[k : k + n] for k in range(words)])
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(all_of[a : b - words + 1]))
        elif b > a:
            out.append(_chained([h[k : k + 1] for k in range(a, b)]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def sketches(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """Fast similarity sketch of each set: one row of `bins` values, each the smallest (round, hash) that fell into the bin.

    In rounds 0 .. bins-1 every element is placed into a bin by that round's hash; in
    round bins+i all elements go to bin i. A set stops after the round that filled its
    last bin, so each coordinate is filled and equal in two sets with the probability of
    their Jaccard similarity, with concentration. Empty sets have the largest value.
    """
    n = len(sets)
    out = np.full(n * bins, np.iinfo(np.uint64).max, dtype=np.uint64)
    left = np.array([i for i, s in enumerate(sets) if len(s)], dtype=np.int64)
    low = np.uint64((1 << 52) - 1)
    for turn in range(2 * bins):
        if not len(left):
            break
        sizes = np.array([len(sets[i]) for i in left])
        owner = np.repeat(left * bins, sizes)
        x = np.concatenate([sets[i] for i in left])
        h = mix(x, 1000 + turn)
        place = owner + ((h >> np.uint64(52)) % np.uint64(bins) if bins & (bins - 1) else (h >> np.uint64(52)) & np.uint64(bins - 1)).astype(np.int64) if turn < bins else owner + (turn - bins)
        np.minimum.at(out, place, (np.uint64(turn) << np.uint64(52)) | (h & low))
        full = (out.reshape(n, bins)[left] != np.iinfo(np.uint64).max).all(axis=1)
        left = left[~full]
    return out.reshape(n, bins)


def bands(sketch: np.ndarray, n_bands: int) -> np.ndarray:
    """One hash per band of each sketch, as signed 64-bit integers."""
    n, bins = sketch.shape
    rows = bins // n_bands
    with np.errstate(over="ignore"):
        acc = np.zeros((n, n_bands), np.uint64)
        for k in range(rows):
            acc = mix(acc ^ sketch[:, k::rows][:, :n_bands], 17 + k)
        acc = mix(acc + np.arange(n_bands, dtype=np.uint64)[None, :], 99)
    return acc.view(np.int64)
