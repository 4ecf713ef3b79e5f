"""Principal components of a set of vectors."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexivane.functions import vector as V


def scores(df: DataFrame, vector_col: str, k: int, centered: bool, names: list[str]) -> DataFrame:
    """df with its first k principal scores (U times S), each signed so that its largest coordinate is positive.

    Tasks sum outer products, dim x dim numbers each, and their sums are added up by a
    grouped aggregation, so that the driver gets one such matrix, which it solves; scores
    are dot products with its leading vectors. dim is bounded by that, rows are not.
    """

    def run(frames):
        total, outer, n = None, None, 0
        for pdf in frames:
            if len(pdf):
                x = np.array(pdf[vector_col].tolist(), dtype=np.float64)
                total = x.sum(0) if total is None else total + x.sum(0)
                outer = x.T @ x if outer is None else outer + x.T @ x
                n += len(x)
        if n:
            # Row -1 has the sums of the components, and at its end the number of rows.
            yield pd.DataFrame({"i": np.arange(-1, len(total)), "values": [np.append(total, n), *outer]})

    sums = df.select(vector_col).mapInPandas(run, "i int, values array<double>").select("i", F.posexplode("values").alias("j", "x"))
    parts = {(p.i, p.j): p.x for p in sums.groupBy("i", "j").agg(F.sum("x").alias("x")).collect()}
    if not parts:
        return df.select("*", *[F.lit(None).cast("double").alias(x) for x in names])
    dim = max(i for i, _ in parts) + 1
    n = parts[-1, dim]
    mean = np.array([parts[-1, j] for j in range(dim)]) / n
    gram = np.array([[parts[i, j] for j in range(dim)] for i in range(dim)])
    shift = mean if centered else np.zeros_like(mean)
    if centered:
        gram = gram - n * np.outer(mean, mean)
    _, vectors = np.linalg.eigh(gram)
    made = df
    for i, name in enumerate(names):
        if i >= len(mean):
            made = made.withColumn(name, F.lit(0.0))
            continue
        axis = vectors[:, -1 - i]
        made = made.withColumn(name, V.similarity(F.col(vector_col), axis) - float(shift @ axis))
    ends = made.agg(*[F.max(F.abs(c)).alias(f"m_{c}") for c in names], *[F.max(c).alias(f"p_{c}") for c in names]).head()
    for name in names:
        if ends[f"p_{name}"] is not None and ends[f"p_{name}"] < ends[f"m_{name}"]:
            made = made.withColumn(name, -F.col(name))
    return made
