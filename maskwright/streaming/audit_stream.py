"""Counting personal data per time window on a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from maskwright.functions import rows
from maskwright.operators.detect import detect
from maskwright.sources.files import children


def _found(df: DataFrame, text: str | Column, categories: list[str] | None) -> DataFrame:
    """``__at`` and the categories found, for a frame that has ``__at``."""
    found = detect(
        df.select("__at", rows.as_column(text).alias("__text")),
        "__text", categories, include_samples=False, output_field="__pii", on_error="keep",
    )
    return found.select("__at", F.col("__pii.found_pii").alias("__found"))


def _window(window: str, slide: str | None) -> Column:
    return F.window("__at", window, slide) if slide else F.window("__at", window)


def stream_audit(
    df: DataFrame,
    event_time: str,
    text: str | Column = "text",
    categories: list[str] | None = None,
    window: str = "10 minutes",
    slide: str | None = None,
    delay: str = "10 minutes",
) -> DataFrame:
    """Hits and rows with hits per window and category.

    In append mode a window is given out once the watermark has passed its end. State is one
    pair of sums per open window and category, whatever the number of rows; batch frames work
    as well.
    """
    kind = df.select(event_time).schema[0].dataType
    timed = df.withColumn("__at", F.col(event_time).cast("timestamp"))
    if df.isStreaming:
        timed = timed.withWatermark("__at", delay)
    return (
        _found(timed, text, categories)
        .select("__at", F.explode("__found").alias("f"))
        .groupBy(_window(window, slide).alias("span"), F.col("f.category").alias("category"))
        .agg(
            F.sum("f.count").alias("hits"),
            F.count("*").alias("rows_with_hits"),
        )
        .select(
            F.col("span.start").cast(kind).alias("window_start"),
            F.col("span.end").cast(kind).alias("window_end"),
            "category",
            "hits",
            "rows_with_hits",
        )
    )


BATCH = "batch_id="


def audit_to_table(
    df: DataFrame,
    path: str,
    checkpoint: str,
    event_time: str,
    text: str | Column = "text",
    categories: list[str] | None = None,
    window: str = "10 minutes",
    slide: str | None = None,
    delay: str = "10 minutes",
) -> DataStreamWriter:
    """Stream writer of the same counts in which rows that come too late are counted, too.

    Spark's own watermark drops a row whose window has closed, without a trace of which window. Here
    each batch writes its sums per window and category, those of closed windows as late, and the
    greatest event time so far; a replayed batch overwrites its own. The watermark of a batch is that time
    as the batch before left it, less ``delay``. A batch reads one row of what came before, whatever the
    number of windows. :func:`read_audit` adds the batches up.
    """
    timed = df.withColumn("__at", F.col(event_time).cast("timestamp"))
    found = _found(timed, text, categories)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        mark = _mark(spark, path, batch_id)
        closed = F.lit(mark).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        seen = Observation()
        sums = (
            batch.observe(seen, F.max("__at").alias("at"))
            .select("__at", F.explode("__found").alias("f"))
            .groupBy(_window(window, slide).alias("span"), F.col("f.category").alias("category"))
            .agg(F.sum("f.count").alias("hits"), F.count("*").alias("rows_with_hits"))
            .select(
                F.col("span.start").alias("window_start"), F.col("span.end").alias("window_end"),
                "category", "hits", "rows_with_hits",
                F.coalesce(F.col("span.end") <= closed, F.lit(False)).alias("late"),
            )
        )
        sums.write.mode("overwrite").parquet(f"{path}/sums/{BATCH}{batch_id}")
        times = [t for t in (mark, seen.get["at"]) if t is not None]
        at = spark.createDataFrame([(max(times, default=None), delay)], "at timestamp, delay string")
        at.write.mode("overwrite").parquet(f"{path}/marks/{BATCH}{batch_id}")

    return found.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def _mark(spark: SparkSession, path: str, before: int):
    """The greatest event time of all batches before one."""
    known = [int(n.removeprefix(BATCH)) for n in children(spark, f"{path}/marks") if n.startswith(BATCH)]
    last = max((n for n in known if n < before), default=None)
    return None if last is None else spark.read.parquet(f"{path}/marks/{BATCH}{last}").first()["at"]


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """Hits and rows with hits per window and category: in time, late, and whether the window is closed."""
    marks = spark.read.parquet(f"{path}/marks").agg(
        F.max("at").alias("at"), F.max_by("delay", "batch_id").alias("delay")
    ).first()
    if marks["at"] is None:
        closed = F.lit(False)
    else:
        closed = F.col("window_end") <= F.lit(marks["at"]) - F.expr(f"INTERVAL {marks['delay']}")

    def total(value: str, late: bool) -> Column:
        return F.sum(F.when(F.col("late") == late, F.col(value)).otherwise(0))

    return (
        spark.read.parquet(f"{path}/sums")
        .groupBy("window_start", "window_end", "category")
        .agg(
            total("hits", False).alias("hits"),
            total("rows_with_hits", False).alias("rows_with_hits"),
            total("hits", True).alias("late_hits"),
            total("rows_with_hits", True).alias("late_rows"),
        )
        .withColumn("closed", closed)
    )
