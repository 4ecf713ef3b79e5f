"""Text functions as Column expressions; only Unicode normalisation and segmentation leave the JVM."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: What the symbol flag replaces by a space, tags and single characters.
TAGS = "<[^>]*>"
SYMBOLS = "0123456789,.;:&^/-−#'\"()[]、。【】「」~・"
LETTERS = "[a-zA-Z]+"


@F.pandas_udf(StringType())
def nfkc_lower(texts: pd.Series) -> pd.Series:
    """NFKC and lower case, Arrow batches at a time."""
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t).lower())


def normalize(c: Column, mode: str = "auto") -> Column:
    """`auto`: NFKC and lower case; `lower`: lower case alone, in the JVM, right for NFKC-stable data; `none`: as it is."""
    mode = (mode or "auto").lower()
    if mode in ("none", ""):
        return c
    if mode == "lower":
        return F.lower(c)
    if mode in ("auto", "normalizerauto"):
        return nfkc_lower(c)
    raise ValueError(f"unknown normalizer: {mode}")


def normalize_driver(text: str, mode: str = "auto") -> str:
    mode = (mode or "auto").lower()
    if mode in ("none", ""):
        return text
    return text.lower() if mode == "lower" else unicodedata.normalize("NFKC", text).lower()


_RUN = re.compile(r"[ぁ-ゖゝゞ]+|[ァ-ヺー-ヿ]+|[一-鿿々㐀-䶿]+|[^\W_ぁ-ヿ一-鿿㐀-䶿]+|[^\w\s]+|_+")


def script_runs(text: str) -> str:
    """Runs of one script, separated by spaces: the built-in segmenter."""
    return " ".join(_RUN.findall(text))


def segmented(c: Column, tokenizer=None) -> Column:
    """Segment by a function of one string to a space-separated string (default: script runs)."""
    cut = tokenizer or script_runs

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else cut(t))

    return run(c)


def squeeze(c: Column) -> Column:
    return F.regexp_replace(c, " {2,}", " ")


def without_symbols(c: Column) -> Column:
    """Tags and symbols as spaces. No symbol opens or closes a tag, so tags can go first; a translation is several times as fast as matching a class."""
    c = F.when(F.contains(c, F.lit("<")), F.regexp_replace(c, TAGS, " ")).otherwise(c)
    return squeeze(F.translate(c, SYMBOLS, " " * len(SYMBOLS)))


def replaced_by_space(c: Column, pattern: str) -> Column:
    return squeeze(F.regexp_replace(c, pattern, " "))


def phrase(c: Column) -> Column:
    return F.translate(c, " ", "_")


def rtrim_lines(c: Column) -> Column:
    """Trailing line ends, then trailing spaces."""
    return F.rtrim(F.rtrim(c, F.lit("\n")), F.lit(" "))


def full_match(c: Column, pattern: str) -> Column:
    """The whole string matches; an invalid pattern raises when it is evaluated."""
    return c.rlike(rf"\A(?:{pattern})\z")


def edit_distance(a: Column, b: Column, compat: bool = False) -> Column:
    """Levenshtein distance in characters; compat leaves the last character of either string out."""
    if compat:
        cut = lambda x: F.when(F.char_length(x) > 0, F.substr(x, F.lit(1), F.char_length(x) - 1)).otherwise(F.lit(""))
        a, b = cut(a), cut(b)
    return F.levenshtein(a, b)


def doc_id_of(word: Column) -> Column:
    """The id of a `doc_id:<id>` word; null for other words."""
    return F.when(word.rlike("^doc_id:[0-9]{1,18}$"), F.substring(word, 8, 18)).cast("long")
