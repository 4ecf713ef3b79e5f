"""Query expansion by similar words, and search with it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexivane.operators.distance import distance

THRESHOLD, LIMIT = 0.75, 3


def expand_query(model: DataFrame, term: str, threshold: float = THRESHOLD, limit: int = LIMIT, compat: bool = False, **options) -> str:
    """`((term) OR (near) ...)`; the term alone if nothing is near enough or it isn't known. compat keeps one alternative."""
    found = distance(model, term, threshold=threshold, limit=limit, normalizer=options.pop("normalizer", "none"), expander_mode=True, compat=compat, **options)
    return found.expanded or term


def alternatives(expanded: str) -> list[str]:
    """The words of an expanded query."""
    if expanded.startswith("((") and expanded.endswith("))"):
        return expanded[2:-2].split(") OR (")
    return [expanded]


def search(df: DataFrame, match_columns: str, query: str, expander=None, normalizer: str = "lower") -> DataFrame:
    """Rows of which a match column holds the query or, with an expander (a function of the query), one of its alternatives: one scan with an OR."""
    words = alternatives(expander(query)) if expander else [query]
    low = normalizer != "none"
    found = F.lit(False)
    for c in match_columns.split(","):
        c = c.strip()
        for w in words:
            w = w.lower() if low else w
            if df.schema[c].dataType.simpleString() == "array<string>":
                found = found | F.array_contains(F.transform(F.col(c), F.lower) if low else F.col(c), w)
            else:
                found = found | F.contains(F.lower(c) if low else F.col(c), F.lit(w))
    return df.filter(found)
