"""Seeded initial vectors: one linear congruential sequence over (word_id, dimension), row-major."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of the public initialisation, reduced to the 16 bits that it uses.
MULTIPLIER, INCREMENT, MODULUS, FIRST = 58989, 11, 1 << 16, 1


@lru_cache(maxsize=1)
def states() -> np.ndarray:
    """The states after 1, 2, ... steps; the sequence has full period."""
    out, s = np.empty(MODULUS, np.int64), FIRST
    for i in range(MODULUS):
        s = (MULTIPLIER * s + INCREMENT) % MODULUS
        out[i] = s
    return out


def vector_of(word_id: int, dim: int, decimals: int | None = None) -> np.ndarray:
    at = (np.int64(word_id) * dim + np.arange(dim)) % MODULUS
    v = (states()[at] / MODULUS - 0.5) / dim
    return np.round(v, decimals) if decimals is not None else v


def initial_vectors(vocab: DataFrame, dim: int = 100, decimals: int | None = None) -> DataFrame:
    """word_id, word, vector (array<float>, not of unit length) for each word of a vocabulary."""

    @F.pandas_udf("array<float>")
    def made(ids: pd.Series) -> pd.Series:
        at = (ids.to_numpy(np.int64)[:, None] * dim + np.arange(dim)) % MODULUS
        v = (states()[at] / MODULUS - 0.5) / dim
        return pd.Series(list((np.round(v, decimals) if decimals is not None else v).astype(np.float32)))

    return vocab.select("word_id", "word", made("word_id").alias("vector"))
