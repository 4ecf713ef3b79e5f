"""Mixing sources to target weights by systematic sampling.

Each source gets a target number of words; a document of it is expected
target / source_size times. Within a source, ordered by size and key, the expected copies
are prefix-summed, one random offset in [0, 1) is added, and a document is emitted once
per integer boundary that its interval crosses. As the order is by size, the words taken
stay within about one document of the target.

The prefix sum is spread over range partitions: documents are dealt by (source, size,
key), each partition counts its rows per source, and only these counts (at most one row
for each partition and source it holds, plus one) are summed over partitions. No source
is gathered in one task.

Defined results: null text has size 0; a null source is a source of its own, ordered
last; documents of size 0 take no words, though copies of them are made; sources whose
size is 0 have target 0 and no copies; repeated rows are rows of their own; an empty table
gives an empty result; other columns are kept, whatever their names. The sources (a row
each) are ranked and summed in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexivane.llm.common import materialize, row_hash, scratch, words

CAP = 3.0
WEIGHTS = (1.0, 2.0, 3.0)
SEED = 20


def targets(sizes: DataFrame, source_col: str = "source", weights=WEIGHTS, cap: float = CAP, share: float = 1.0) -> DataFrame:
    """One row per source of `sizes` (source, n_docs, source_size): its weight and target.

    Weights go round in code-point order of the sources, null last. Targets share the sum
    of all sizes by weight; those above cap times their source's size stop there and the
    excess is shared again among the rest by weight, until none is above. In closed form
    a source is capped when (cap * size / weight) is below the final rate, so sources are
    ordered by that ratio and the rate is found from running sums: no loop, no collect.
    """
    ranked = sizes.withColumn("_at", F.row_number().over(Window.orderBy(F.col(source_col).asc_nulls_last())) - 1)
    ranked = ranked.withColumn("_w", F.element_at(F.array(*map(F.lit, weights)), (F.col("_at") % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("_most", F.lit(cap) * F.col("source_size")).withColumn("_ratio", F.col("_most") / F.col("_w"))
    upto = Window.orderBy("_ratio", "_at").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    ranked = (
        ranked.withColumn("_total", F.lit(share) * F.sum("source_size").over(everything))
        .withColumn("_capped", F.coalesce(F.sum("_most").over(upto), F.lit(0.0)))
        .withColumn("_rest", F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(upto), F.lit(0.0)))
        # the rate if exactly the sources before this one are capped; it holds at the first source whose ratio isn't below it
        .withColumn("_rate", (F.col("_total") - F.col("_capped")) / F.col("_rest"))
    )
    rate = F.min(F.when(F.col("_ratio") >= F.col("_rate"), F.struct("_ratio", "_at", "_rate"))).over(everything)["_rate"]
    return ranked.withColumn("_final", rate).select(
        source_col,
        "source_size",
        "n_docs",
        F.col("_w").alias("weight"),
        F.when(F.col("_final").isNull() | (F.col("_ratio") < F.col("_final")), F.col("_most")).otherwise(F.col("_final") * F.col("_w")).cast("double").alias("target"),
    )


def offset_of(source, seed: int):
    """One offset in [0, 1) for a source, the same in every run; of 20 bits, so that sums with ranks up to 2^31 and three times that are exact."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit("")))), 1, 5), 16, 10).cast("double") / F.lit(float(1 << 20))


def copies(docs: DataFrame, key_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights=WEIGHTS, cap: float = CAP, share: float = 1.0, seed: int = SEED) -> DataFrame:
    """doc_id, source, size, tie (a hash of the row), source_size, target and n_copies of each document: a slim table without texts."""
    spark = docs.sparkSession
    slim = docs.select(F.col(key_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.size(words(F.col(text_col))).cast("long").alias("size"), row_hash(docs).alias("tie"))
    with scratch(spark) as keep:
        slim = materialize(slim, "sizes")  # texts are read and split once
        n = max(2, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
        order = [F.col("source").asc_nulls_last(), F.col("size"), F.col("doc_id"), F.col("tie")]
        # The id that Spark counts up within a partition gives a row's place in it: high bits partition, low 33 bits place.
        dealt = slim.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
        dealt = keep(materialize(dealt.select("*", F.shiftright("_id", 33).cast("int").alias("part"), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)).alias("place")).drop("_id"), "dealt"))
        counts = keep(materialize(dealt.groupBy("part", "source").agg(F.count("*").alias("n"), F.sum("size").alias("words"), F.min("place").alias("first")), "counts"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    goal = targets(counts.groupBy("source").agg(F.sum("n").alias("n_docs"), F.sum("words").cast("long").alias("source_size")), "source", weights, cap, share)
    c, g = counts.withColumn("before", before).alias("c"), goal.alias("g")
    plan = c.join(g, F.col("c.source").eqNullSafe(F.col("g.source"))).select("c.part", "c.source", "c.first", "c.before", "g.source_size", "g.target")
    joined = dealt.alias("d").join(plan.alias("p"), (F.col("d.part") == F.col("p.part")) & F.col("d.source").eqNullSafe(F.col("p.source")))
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rank = F.col("before") + F.col("place") - F.col("first") + 1
    u = offset_of(F.col("d.source"), seed)
    return joined.select("d.doc_id", "d.source", "size", "tie", "source_size", "target", (F.floor(rank * each + u) - F.floor((rank - 1) * each + u)).cast("long").alias("n_copies"))


def mix(docs: DataFrame, key_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **options) -> DataFrame:
    """The mixture itself: each row of docs, with all of its columns, as often as it is taken.

    Rows alike in all columns are interchangeable: one stands for them, as often as they
    are taken together. The texts are shuffled once.
    """
    key = F.coalesce(F.col(key_col).cast("string"), F.lit("\0null"))
    plan = copies(docs, key_col, source_col, text_col, **options)
    taken = plan.groupBy(F.coalesce(F.col("doc_id").cast("string"), F.lit("\0null")).alias("k"), F.col("tie").alias("h")).agg(F.sum("n_copies").cast("int").alias("n")).filter("n > 0")
    rows = docs.select(key.alias("k"), row_hash(docs).alias("h"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).groupBy("k", "h").agg(F.first("row").alias("row"))
    return rows.join(taken, ["k", "h"]).select("row", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("i")).select("row.*")
