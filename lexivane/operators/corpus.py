"""Tables to training corpora: one line of tokens per row."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexivane.operators.columnspec import parse_columns
from lexivane.operators.textprep import elements

_MATCH = re.compile(r"""^\s*(\w+)\s*@\s*(?:"((?:[^"\\]|\\.)*)"|'((?:[^'\\]|\\.)*)')\s*$""")
_COMPARE = re.compile(r"""^\s*(\w+)\s*(==|!=|>=|<=|>|<)\s*(?:"((?:[^"\\]|\\.)*)"|(-?[0-9.]+))\s*$""")


def script_filter(df: DataFrame, text: str) -> Column:
    """A filter in script syntax: `col @ "text"` (contains, case-blind) and comparisons, joined by && or ||; anything else is Spark SQL."""
    for word, join in (("||", lambda a, b: a | b), ("&&", lambda a, b: a & b)):
        parts = _outside_quotes(text, word)
        if len(parts) > 1:
            made = [script_filter(df, p) for p in parts]
            out = made[0]
            for m in made[1:]:
                out = join(out, m)
            return out
    if m := _MATCH.match(text):
        wanted = F.lower(F.lit(re.sub(r"\\(.)", r"\1", m[2] if m[2] is not None else m[3])))
        if df.schema[m[1]].dataType.simpleString() == "array<string>":
            return F.exists(F.col(m[1]), lambda x: F.lower(x) == wanted)
        return F.contains(F.lower(F.col(m[1])), wanted)
    if m := _COMPARE.match(text):
        value = F.lit(re.sub(r"\\(.)", r"\1", m[3])) if m[3] is not None else F.expr(m[4])
        c = F.col(m[1])
        return {"==": c == value, "!=": c != value, ">=": c >= value, "<=": c <= value, ">": c > value, "<": c < value}[m[2]]
    return F.expr(text)


def _outside_quotes(text: str, word: str) -> list[str]:
    parts, quote, at, i = [], "", 0, 0
    while i < len(text):
        c = text[i]
        if quote:
            if c == "\\":
                i += 1
            elif c == quote:
                quote = ""
        elif c in "\"'":
            quote = c
        elif text.startswith(word, i):
            parts.append(text[at:i])
            i += len(word)
            at = i
            continue
        i += 1
    return [*parts, text[at:]]


def dump_corpus(df: DataFrame, columns: str, filter: str | Column | None = None, id_col: str | None = None, normalizer: str = "auto", input_filter: str | None = None, tokenizer=None, sentence_vectors: bool = False) -> DataFrame:
    """doc_id and line for each row of df that the filter keeps: cleaned elements joined by one space, in one narrow stage.

    Rows without tokens keep an empty line. With sentence_vectors a line starts with
    `doc_id:<id> `. Line ends inside elements become spaces, so that a line is one line.
    """
    specs = parse_columns(columns)
    for s in specs:
        if s.name not in df.columns:
            raise ValueError(f"no column {s.name!r}")
    if sentence_vectors and id_col is None:
        raise ValueError("sentence vectors need id_col")
    if filter is not None:
        df = df.filter(filter if isinstance(filter, Column) else script_filter(df, filter))
    tokens = F.concat(*[elements(df, s, normalizer, input_filter, tokenizer) for s in specs])
    line = F.regexp_replace(F.array_join(tokens, " "), r"[\r\n]+", " ")
    key = F.col(id_col) if id_col else F.lit(None)
    if sentence_vectors:
        line = F.concat(F.lit("doc_id:"), key.cast("string"), F.lit(" "), line)
    return df.select(key.cast("long").alias("doc_id"), line.alias("line"))


def resolve_reference(df: DataFrame, column: str, lookup: DataFrame, id_col: str, key_col: str) -> DataFrame:
    """df with a reference column replaced by the key it refers to; null where there is none. Spark broadcasts the lookup when it is small."""
    names = lookup.select(F.col(id_col).alias("__id"), F.col(key_col).cast("string").alias("__key"))
    joined = df.join(names, F.col(column) == F.col("__id"), "left")
    return joined.select(*[F.col("__key").alias(c) if c == column else F.col(c) for c in df.columns])


def resolve_reference_vector(df: DataFrame, column: str, lookup: DataFrame, id_col: str, key_col: str, row_key: str) -> DataFrame:
    """df with an array of references replaced by an array of keys in the same order; references to nothing are left out. row_key names a unique column."""
    names = lookup.select(F.col(id_col).alias("__id"), F.col(key_col).cast("string").alias("__key"))
    flat = df.select(F.col(row_key).alias("__row"), F.posexplode(column).alias("__pos", "__id")).join(names, "__id")
    found = flat.groupBy("__row").agg(F.transform(F.array_sort(F.collect_list(F.struct("__pos", "__key"))), lambda x: x["__key"]).alias("__keys"))
    joined = df.join(found, F.col(row_key) == F.col("__row"), "left")
    return joined.select(*[F.coalesce("__keys", F.array().cast("array<string>")).alias(c) if c == column else F.col(c) for c in df.columns])


def tokens_of(line: Column) -> Column:
    """The tokens of a line: split at white space."""
    return F.filter(F.split(line, r"[ \t\n\r]+"), lambda w: w != "")
