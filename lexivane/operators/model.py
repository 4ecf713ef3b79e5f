"""Vector models and their registry."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexivane.functions import vector as V
from lexivane.storage import remove, written


@dataclass
class VectorModel:
    """word_id, word and a unit vector (array<float>) per row; zero vectors are left out, as they are near nothing."""

    df: DataFrame
    dim: int

    @classmethod
    def from_vectors(cls, df: DataFrame, dim: int | None = None) -> "VectorModel":
        """From word_id, word, vector of any length: unit vectors are made once, so that cosine is a dot product."""
        u = df.select("word_id", "word", V.unit(F.col("vector")).cast("array<float>").alias("vector")).filter(F.col("vector").isNotNull())
        if dim is None:
            row = df.select(F.size("vector").alias("n")).head()
            dim = row.n if row else 0
        return cls(u, dim)

    def persist(self) -> "VectorModel":
        self.df = self.df.persist()
        return self


class Registry:
    """Models by path. A path that is asked for loads once; loading it explicitly loads anew, and until then a model stays as it was loaded: in a table of unit vectors of the registry's own, whatever becomes of the file."""

    def __init__(self):
        self._models: dict[str, VectorModel] = {}

    def load(self, spark, path: str, binary: bool = True) -> bool:
        from lexivane.sources.model_io import read_model

        try:
            model = read_model(spark, path, binary)
        except FileNotFoundError:
            return False
        self.drop(path)
        self._models[path] = VectorModel(written(model.df), model.dim).persist()
        return True

    def get(self, spark, path: str, binary: bool = True) -> VectorModel:
        if path not in self._models and not self.load(spark, path, binary):
            raise FileNotFoundError(path)
        return self._models[path]

    def drop(self, path: str) -> None:
        if (m := self._models.pop(path, None)) is not None:
            m.df.unpersist()
            remove(m.df)

    def unload_all(self) -> bool:
        for path in list(self._models):
            self.drop(path)
        return True
