"""Session settings that the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution is relied on for three things: joining small mappings by broadcast only
# after their size is known, splitting a mapping id shared by very many rows, and sizing
# partitions after a shuffle. All are Spark defaults, stated so that nobody turns them off.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Of keys that a JSON object repeats the last one counts, as in other readers.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Apply the settings to a session builder."""
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder


def local_session(cpus: int | str = "*", memory: str = "8g", **settings: str) -> SparkSession:
    """Single-machine session for tests and benchmarks."""
    cores = str(cpus) if str(cpus).isdigit() else "8"
    builder = configure(SparkSession.builder.master(f"local[{cpus}]")).config(
        "spark.sql.shuffle.partitions", cores
    )
    builder = (
        builder.config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
