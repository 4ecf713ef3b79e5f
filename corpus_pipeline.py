"""The corpus pipeline: toxicity, quality, near-duplicates, mixing, BPE.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept;
all but the last return the columns that they got. Classifiers learn from the documents
and labels in sf_dir, by the rows that the operators' own queries learn from. Empty
tables pass through every stage; nulls, repeated rows and clashing column names are
handled as the operators say.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lexivane.llm import bpe, mixing, neardup, quality, toxicity
from lexivane.llm.common import materialize, remove_path, scratch, table
from lexivane.llm.queries import quality_model, tokenizer_path, toxicity_model

#: Near copies are linked from this Jaccard similarity of five-word shingles on, in percent; bands of 4 of the 256 coordinates miss such a pair with probability 2e-15.
NEAR_PERCENT, NEAR_BANDS = 80, 64


def drop_toxic(spark, docs, sf_dir):
    scored = toxicity.score(docs, toxicity_model(spark, sf_dir))
    return scored.filter(F.col(f"`{scored.columns[-2]}`") < toxicity.THRESHOLD).select(*[F.col(f"`{c}`") for c in docs.columns])


def keep_quality(spark, docs, sf_dir):
    scored = quality.score(docs, quality_model(spark, sf_dir))
    return scored.filter(F.col(f"`{scored.columns[-1]}`") >= quality.THRESHOLD).select(*[F.col(f"`{c}`") for c in docs.columns])


def one_of_each_group(spark, docs, sf_dir):
    return neardup.deduplicate(docs, percent=NEAR_PERCENT, n_bands=NEAR_BANDS)


def mix_sources(spark, docs, sf_dir):
    return mixing.mix(docs)


def encode_bpe(spark, docs, sf_dir):
    slim = docs.select("doc_id", "source", "text")
    coded = bpe.encode(slim, tokenizer_path(), decoded_col="decoded")
    return coded.select("doc_id", "source", *bpe.digests(coded), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("quality classifier", keep_quality),
    ("MinHash near-dedup", one_of_each_group),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", encode_bpe),
]

#: SQL can't express the trained stages.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The stages in a row. Each one's rows are written and read again; its own tables, and the rows of the stage before, are deleted then."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with scratch(spark) as keep:
            docs = keep(materialize(stage(spark, docs, sf_dir), name.split()[0].lower()))
        if before:
            remove_path(spark, before)
        before = docs.work_path.rsplit("/", 1)[0]
    return STAGES[-1][1](spark, docs, sf_dir)
