"""The element pipeline of the corpus builder, in its fixed order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexivane.functions import text as T
from lexivane.operators.columnspec import ColumnSpec


def cleaned(c: Column, spec: ColumnSpec, normalizer: str = "auto", input_filter: str | None = None, tokenizer=None) -> Column:
    """One element, before empty ones are dropped: normalise, segment, filter, symbols, letters, phrase, label, trim."""
    c = T.normalize(F.coalesce(c, F.lit("")), normalizer)
    if spec.segment:
        c = T.segmented(c, tokenizer)
    if input_filter:
        c = T.replaced_by_space(c, input_filter)
    if spec.strip_symbols:
        c = T.without_symbols(c)
    if spec.strip_letters:
        c = T.replaced_by_space(c, T.LETTERS)
    if spec.phrase:
        c = T.phrase(c)
    if spec.label:
        c = F.concat(F.lit(spec.label), c)
    return T.rtrim_lines(c)


def elements(df, spec: ColumnSpec, normalizer: str = "auto", input_filter: str | None = None, tokenizer=None) -> Column:
    """The column's elements as array<string>: text columns give one, arrays one for each of theirs."""
    kind = df.schema[spec.name].dataType.simpleString()
    c = F.col(f"`{spec.name}`")
    if kind == "array<string>":
        leaves_jvm = spec.segment or (normalizer or "auto").lower() in ("auto", "normalizerauto")
        if leaves_jvm:
            # Python functions can't run inside transform: joined by a character that no normaliser makes, cleaned as one string per row, split again.
            sep = "\x1e"
            whole = F.array_join(F.transform(F.coalesce(c, F.array()), lambda x: F.coalesce(x, F.lit(""))), sep)
            whole = T.normalize(whole, normalizer)
            if spec.segment:
                cut = tokenizer or T.script_runs
                whole = T.segmented(whole, lambda t, cut=cut: sep.join(cut(x) for x in t.split(sep)))
            c = F.when(F.size(F.coalesce(c, F.array())) > 0, F.split(whole, sep)).otherwise(F.array().cast("array<string>"))
            plain = ColumnSpec(spec.name, False, spec.phrase, spec.strip_letters, spec.strip_symbols, spec.repeat, spec.label)
            made = F.transform(c, lambda x: cleaned(x, plain, "none", input_filter))
        else:
            made = F.transform(F.coalesce(c, F.array()), lambda x: cleaned(x, spec, normalizer, input_filter))
    elif kind == "string":
        made = F.array(cleaned(c, spec, normalizer, input_filter, tokenizer))
    else:
        made = F.array(cleaned(c.cast("string"), spec, normalizer, input_filter, tokenizer))
    # A label alone isn't empty, as the element it stands before was there.
    made = F.filter(made, lambda x: F.length(x) > 0)
    if spec.repeat > 1:
        made = F.flatten(F.transform(made, lambda x: F.array_repeat(x, spec.repeat)))
    return made
