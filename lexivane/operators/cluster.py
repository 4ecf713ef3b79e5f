"""Word classes: k-means on unit vectors.

Spark ML's k-means starts them and goes on while a centre moves at all (by NEAR of cosine
distance). In large classes a centre that seems to rest can still lose words to others, so
rounds of this module follow, by the exact means, until no word has a nearer class than its
own; most often the first one finds none.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Cosine distance by which a centre that has moved is still where it was, rounds of Spark ML's, and by how much nearer another class must be: sums in another order differ by less.
NEAR, MOST_ROUNDS, NEARER = 1e-15, 10_000, 1e-12


def _directions(sums: np.ndarray, old: np.ndarray) -> np.ndarray:
    """Unit vectors of the sums; where there is none, the old one."""
    size = np.sqrt((sums**2).sum(1, keepdims=True))
    return np.where(size > 0, sums / np.where(size > 0, size, 1), old)


def _matrix(vectors) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in vectors])


def _round(model: DataFrame, old: np.ndarray, new: np.ndarray) -> tuple[int, np.ndarray]:
    """How many words have a nearer class by the new centres than the one that the old centres gave them, and the sums of each class by the new ones; one scan."""

    def run(frames):
        moved, sums = 0, np.zeros_like(new)
        for pdf in frames:
            if len(pdf):
                x = _matrix(pdf["vector"])
                near, own = x @ new.T, (x @ old.T).argmax(1)
                moved += int((near.max(1) - near[np.arange(len(x)), own] > NEARER).sum())
                at = near.argmax(1)
                for c in np.unique(at):
                    sums[c] += x[at == c].sum(0)
        yield pd.DataFrame({"class": np.arange(len(new)), "moved": [moved] + [0] * (len(new) - 1), "x": list(sums)})

    parts = model.select("vector").mapInPandas(run, "class int, moved long, x array<double>")
    found = parts.select("class", "moved", F.posexplode("x").alias("j", "x")).groupBy("class", "j").agg(F.sum("moved").alias("moved"), F.sum("x").alias("x"))
    sums, moved = np.zeros_like(new), 0
    for r in found.collect():  # classes x dimensions
        sums[r["class"], r.j] = r.x
        moved = max(moved, r.moved)
    return moved, sums


def classes(model: DataFrame, k: int, seed: int = 1, rounds: int | None = None) -> DataFrame:
    """word_id, word and class (0 .. k-1) of each word, by direction; at rest, unless a number of rounds is given as the most."""
    rows = model.select("word_id", "word", array_to_vector(F.col("vector").cast("array<double>")).alias("features"))
    fitted = KMeans(k=k, seed=seed, maxIter=MOST_ROUNDS if rounds is None else rounds, tol=NEAR, distanceMeasure="cosine", initMode="k-means||").fit(rows)
    if rounds is not None:
        return fitted.transform(rows).select("word_id", "word", F.col("prediction").alias("class"))
    old = _matrix(fitted.clusterCenters())
    old = _directions(old, old)
    new = _directions(_round(model, old, old)[1], old)
    while True:
        moved, sums = _round(model, old, new)
        if not moved:
            break
        old, new = new, _directions(sums, new)

    @F.pandas_udf("int")
    def nearest(vectors: pd.Series) -> pd.Series:
        return pd.Series((_matrix(vectors) @ old.T).argmax(1) if len(vectors) else [], dtype="int32")

    return model.select("word_id", "word", nearest("vector").alias("class"))


def settled(model: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """word_id, word, class, and whether the class's mean direction is the nearest of all classes' to the word (`nearest`), as it is where k-means has come to rest."""
    from lexivane.functions import vector as V

    rows = model.select("word_id", "vector").join(found, "word_id")
    sums = rows.select("class", F.posexplode("vector").alias("j", "x")).groupBy("class", "j").agg(F.sum(F.col("x").cast("double")).alias("x"))
    means = sums.groupBy("class").agg(F.array_sort(F.collect_list(F.struct("j", "x"))).alias("v")).orderBy("class").collect()  # k rows
    near = {m["class"]: V.similarity(F.col("vector"), [p.x for p in m.v]) / sum(p.x**2 for p in m.v) ** 0.5 for m in means}
    best = F.greatest(*near.values()) if len(near) > 1 else next(iter(near.values()), F.lit(None))
    own = F.coalesce(*[F.when(F.col("class") == c, x) for c, x in near.items()]) if near else F.lit(None)
    return rows.select("word_id", "word", "class", (own >= best - 1e-9).alias("nearest"))
