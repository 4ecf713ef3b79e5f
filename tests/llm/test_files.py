"""How the operators' tables are read and written as files."""

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from lexivane.llm.common import materialize, remove_path, table


def direct_mb(spark):
    beans = spark._jvm.java.lang.management.ManagementFactory.getPlatformMXBeans(spark._jvm.java.lang.Class.forName("java.lang.management.BufferPoolMXBean"))
    return sum(b.getMemoryUsed() for b in beans if b.getName() == "direct") / 1e6


def test_large_row_groups(spark, tmp_path):
    """A large row group is read without a second copy of it in direct buffers; what is written of it lies in small ones."""
    text = F.concat(*[F.sha2(F.concat("id", F.lit(f" {k}")), 512) for k in range(16)])
    made = spark.range(0, 25_000, 1, 1).select(F.col("id").alias("doc_id"), text.alias("text"))
    made.write.option("parquet.block.size", 1 << 28).parquet(f"{tmp_path}/documents.parquet")
    (path,) = tmp_path.glob("documents.parquet/part-*")
    assert pq.ParquetFile(path).metadata.num_row_groups == 1
    before = direct_mb(spark)
    docs = table(spark, str(tmp_path), "documents")
    assert docs.agg(F.sum(F.length("text")).alias("n")).head().n == 25_000 * 2048
    assert direct_mb(spark) - before < 20
    kept = materialize(docs, "kept")
    sizes = [m.row_group(i).total_byte_size for p in kept.inputFiles() for m in [pq.ParquetFile(p.removeprefix("file://")).metadata] for i in range(m.num_row_groups)]
    assert kept.count() == 25_000 and max(sizes) < 24 << 20
    remove_path(spark, kept.work_path.rsplit("/", 1)[0])


def test_few_rows_are_decoded_at_a_time(spark, tmp_path):
    """A task that reads long texts holds those of a few hundred rows, not of thousands."""
    spark.range(0, 5_000, 1, 1).selectExpr("id as doc_id", "repeat('x', 100) as text").write.parquet(f"{tmp_path}/documents.parquet")
    run = table(spark, str(tmp_path), "documents")._jdf.queryExecution()
    assert run.toRdd().count() == 5_000
    node = run.executedPlan()
    while not node.metrics().contains("numInputBatches"):
        node = node.children().head()
    assert node.metrics().apply("numInputBatches").value() >= 5_000 / 512
