"""A local session with the settings that the engine is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cpus: str = "*", partitions: int = 8, memory: str = "4g", **settings) -> SparkSession:
    b = SparkSession.builder.master(f"local[{cpus}]").appName("lexivane")
    conf = {"spark.sql.shuffle.partitions": partitions, "spark.driver.memory": memory, "spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"} | settings
    for k, v in conf.items():
        b = b.config(k, str(v))
    return b.getOrCreate()
