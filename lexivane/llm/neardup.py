"""Near-duplicates of texts by fast similarity sketches, banding and exact verification.

1. Each text becomes its set of distinct word shingles; texts with equal sets form one
   node, so copies are never compared. A node's sketch comes from rounds of hashed bin
   placement (every coordinate fills), and is cut into bands.
2. In each bucket of a band every node is paired with one pivot, the bucket's least node;
   distinct pairs are verified on full sets. A bucket of n nodes gives n - 1 pairs.
3. Buckets whose nodes are not all connected by then are verified as a whole: every pair
   of nodes in different components, by matrix products over blocks of a bounded number
   of nodes, which report a spanning forest of the links they find. Thus no link between
   nodes that share a bucket is lost, and no list of all pairs is made.
4. Components come from label propagation with pointer jumping on the links.

With the defaults (256 coordinates, 32 bands of 8) a pair at the threshold 0.85 misses all
buckets with probability 4e-5, one at 0.9 with 2e-8. Shingles are compared by strong 64-bit
hashes (see `shingles`), full sets by all of them.

Defined results: null, empty and blank texts have no shingles and stay on their own;
texts of fewer words than a shingle have the whole sequence as one; rows with a null key
count as keyless members (a component's id is its least non-null key, null if it has
none); repeated rows are members of one component; an empty table gives an empty result;
other columns aren't carried over by `components`, and are kept by `deduplicate`. Keys must
be numbers (they are cast to long).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexivane.llm.bpe import slices
from lexivane.llm.common import bounded_batches, free_name, materialize, row_hash, scratch, tidied
from lexivane.llm.shingles import WORDS, bands, shingle_sets, sketches

PERCENT = 85
BINS, BANDS = 256, 32
#: Nodes and shingles of a block of a bucket, about; a pair of blocks is held by one task.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 20
COLUMNS = 4096
NO_KEY = -(1 << 63)


def _set_id(s: np.ndarray) -> bytes | None:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


def signatures(docs: DataFrame, key_col: str, text_col: str, words: int, bins: int, n_bands: int) -> DataFrame:
    """A slim row per row of docs: doc_id, tie (a hash of the row), n_shingles, node (null for empty sets), bands."""
    bounded_batches(docs.sparkSession)
    slim = docs.select(F.col(key_col).cast("long").alias("doc_id"), row_hash(docs).alias("tie"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text", 1_000_000):
                sets = shingle_sets(batch.column(2), words)
                marks = bands(sketches(sets, bins), n_bands)
                some = np.array([len(s) > 0 for s in sets])
                flat = pa.array(marks[some].ravel())
                ends = np.concatenate([[0], np.cumsum(some * n_bands)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), flat)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array([_set_id(s) for s in sets], pa.binary()), lists], names=["doc_id", "tie", "n_shingles", "node", "bands"])

    return slim.mapInArrow(tidied(run), "doc_id long, tie long, n_shingles long, node binary, bands array<long>")


def full_sets(docs: DataFrame, wanted: DataFrame, key_col: str, text_col: str, words: int) -> DataFrame:
    """node and its whole set (array<long>, sorted) for the wanted nodes (node, least), from the texts."""
    key = F.coalesce(F.col(key_col).cast("long"), F.lit(NO_KEY))
    texts = docs.select(key.alias("least"), F.col(text_col).cast("string").alias("text")).join(wanted.select(F.coalesce("least", F.lit(NO_KEY)).alias("least")).distinct(), "least", "left_semi").select("text")

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text", 500_000):
                sets = shingle_sets(batch.column(0), words)
                ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                flat = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([_set_id(s) for s in sets], pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=["node", "shingles"])

    found = texts.mapInArrow(tidied(run), "node binary, shingles array<long>")
    return found.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"])


def linked(inter, m, n, percent: int):
    return 100 * inter >= percent * (m + n - inter)


def bucket_links(rows: pd.DataFrame, percent: int) -> list[tuple[bytes, bytes]]:
    """A spanning forest of the links between nodes of different components in one block pair: rows node, component, shingles, part (0, 1, or 2 for both sides)."""
    nodes, sets = rows["node"].tolist(), [np.asarray(s, dtype=np.int64) for s in rows["shingles"]]
    sizes = np.array([len(s) for s in sets])
    everything = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    values, column, counts = np.unique(everything, return_inverse=True, return_counts=True)
    keep = counts > 1
    owner, column = owner[keep[column]], (np.cumsum(keep) - 1)[column[keep[column]]]
    left = np.flatnonzero(rows["part"].to_numpy() != 1)
    right = np.flatnonzero(rows["part"].to_numpy() != 0)
    inter = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = int(keep.sum())
    for base in range(0, total, COLUMNS):
        a, b = np.searchsorted(column, [base, base + COLUMNS])
        x = np.zeros((len(sets), min(COLUMNS, total - base)), np.float32)
        x[owner[a:b], column[a:b] - base] = 1
        inter += x[left] @ x[right].T
    component = pd.factorize(rows["component"])[0]
    inter = np.rint(inter.astype(np.float64)).astype(np.int64)
    hit = (100 * inter >= percent * (sizes[left][:, None] + sizes[right][None, :] - inter)) & (component[left][:, None] != component[right][None, :])
    parent = list(range(int(component.max()) + 1))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i, j in zip(*np.nonzero(hit)):
        p, q = root(component[left[i]]), root(component[right[j]])
        if p != q:
            parent[p] = q
            out.append((nodes[left[i]], nodes[right[j]]))
    return out


def connected(links: DataFrame) -> DataFrame:
    """node and label (the least node reachable) for each node of the links (a, b). Each round halves the way to the root at least along chains already labelled; rounds end when no label changes."""
    both = materialize(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        seen = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("m"))
        lower = labels.join(seen, "node").select("node", F.least("label", "m").alias("label"), F.col("label").alias("old"))
        lower = materialize(lower, "lower")
        roots = lower.select(F.col("node").alias("label"), F.col("label").alias("root"))
        jumped = materialize(lower.join(roots, "label").select("node", F.least("label", "root").alias("label"), (F.least("label", "root") != F.col("old")).alias("moved")), "labels")
        labels = jumped.select("node", "label")
        if jumped.filter("moved").isEmpty():
            return labels


def components(docs: DataFrame, key_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, words: int = WORDS, bins: int = BINS, n_bands: int = BANDS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, node and tie (a hash of the row) of each row of docs."""
    with scratch(docs.sparkSession) as keep:
        signed = keep(materialize(signatures(docs, key_col, text_col, words, bins, n_bands), "signed"))
        some = signed.filter("node is not null")
        # Copies: one row per distinct set. All that is aggregated besides the key is alike in equal sets.
        nodes = materialize(some.groupBy("node").agg(F.min("doc_id").alias("least"), F.max("n_shingles").alias("n"), F.max("bands").alias("bands")), "nodes")
        spread = materialize(nodes.select("node", "n", F.explode("bands").alias("bucket")), "buckets")
        pivots = spread.groupBy("bucket").agg(F.min(F.struct("node", "n")).alias("p"), F.count("*").alias("m")).filter("m > 1").select("bucket", F.col("p.node").alias("pivot"), F.col("p.n").alias("pn"))
        shared = materialize(spread.join(pivots, "bucket"), "shared")
        wanted = nodes.join(shared.select("node").distinct(), "node", "left_semi").select("node", "least")
        sets = materialize(full_sets(docs, wanted, key_col, text_col, words), "sets")
        near = (F.col("node") != F.col("pivot")) & (100 * F.least("n", "pn") >= percent * F.greatest("n", "pn"))
        pairs = shared.filter(near).select("node", "pivot", "n", "pn").dropDuplicates(["node", "pivot"])
        checked = pairs.join(sets.withColumnRenamed("shingles", "x"), "node").join(sets.select(F.col("node").alias("pivot"), F.col("shingles").alias("y")), "pivot")
        inter = F.size(F.array_intersect("x", "y")).cast("long")
        links = materialize(checked.withColumn("i", inter).filter(linked(F.col("i"), F.col("n"), F.col("pn"), percent)).select(F.col("node").alias("a"), F.col("pivot").alias("b")), "starlinks")
        labels = connected(links)

        # Buckets that still hold several components; buckets of the same nodes are looked at once.
        at = shared.select("bucket", "node", "n").join(labels, "node", "left").withColumn("component", F.coalesce("label", "node")).drop("label")
        at = materialize(at, "placed")
        h = F.xxhash64("node").cast("decimal(38,0)")
        mixed = at.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("m"), F.sum(h).alias("h"), F.sum("n").alias("sum_n")).filter("lo != hi")
        mixed = materialize(mixed.groupBy("h", "m").agg(F.min("bucket").alias("bucket"), F.max("sum_n").alias("sum_n")).select("bucket", F.greatest(F.ceil(F.col("m") / BLOCK), F.ceil(F.col("sum_n") / BLOCK_SHINGLES)).cast("int").alias("k")), "mixed")
        if not mixed.isEmpty():
            block = F.pmod(F.xxhash64("node", "bucket"), F.col("k")).cast("int")
            dealt = at.join(mixed, "bucket").withColumn("block", block)
            # A node goes to the pairs of its block with every block of the bucket.
            dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
            dealt = dealt.select("bucket", "node", "component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), F.when(F.col("block") == F.col("other"), 2).when(F.col("block") < F.col("other"), 0).otherwise(1).alias("part"))
            dealt = dealt.join(sets, "node")

            def verify(pdf: pd.DataFrame) -> pd.DataFrame:
                return pd.DataFrame(bucket_links(pdf, percent), columns=["a", "b"])

            more = dealt.groupBy("bucket", "i", "j").applyInPandas(verify, "a binary, b binary").distinct()
            more = materialize(more, "morelinks")
            if not more.isEmpty():
                labels = connected(links.unionByName(more))
        labels = labels.join(nodes.select("node", "least"), "node")
        roots = labels.groupBy("label").agg(F.min("least").alias("component_id"))
        known = materialize(labels.select("node", "label").join(roots, "label").select("node", "component_id"), "known")
        alone = nodes.select("node", "least").join(known, "node", "left").select("node", F.coalesce("component_id", "least").alias("component_id"))
        alone = keep(materialize(alone, "ids"))
    out = signed.select("doc_id", "n_shingles", "node", "tie").join(alone, "node", "left")
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"), "node", "tie")


def deduplicate(docs: DataFrame, key_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs, all of its columns, with one row of each component: the one of the least key, and of rows alike in key and set any one. Rows without shingles stay."""
    found = components(docs, key_col, text_col, **options).filter("kept and node is not null")
    names, own = docs.columns, free_name(docs, "lexivane_row")
    # Rows of one key can hold several texts, so rows are told apart by a hash of all of their columns; one stands for those alike in key and set.
    # Written before it is made distinct: a join that nothing is grouped on after can have its hot keys split.
    kept = materialize(found.select(F.col("doc_id").alias("k"), "node", "tie"), "kept").groupBy("k", "node").agg(F.min("tie").alias("h")).select("k", "h")
    text = F.col(text_col).cast("string")
    worded = F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias(own), F.col(key_col).cast("long").alias("k"), row_hash(docs).alias("h"), worded.alias("worded"))
    full = rows.filter("worded").alias("r").join(kept.alias("f"), F.col("r.k").eqNullSafe(F.col("f.k")) & (F.col("r.h") == F.col("f.h"))).select(F.col(f"r.{own}"), "r.k", "r.h").dropDuplicates(["k", "h"])
    return full.select(own).union(rows.filter("not worded").select(own)).select(f"{own}.*")
