"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Bytes as ``bytes.translate`` takes them: A-Z become a-z, all others stay.
LOWER_BYTES = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

# White space that separates words: space and the controls 9 to 13.
BLANK_WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else. Texts of ASCII alone take the faster ``lower``."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def fold(text: str) -> str:
    """``lower_ascii`` for a Python string."""
    return text.encode("utf-8", "surrogatepass").translate(LOWER_BYTES).decode(
        "utf-8", "surrogatepass"
    )


def small_batches(
    batches: Iterable[pa.RecordBatch], column: str, most: int
) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that ``column`` holds about ``most`` bytes in each, a row at least.

    Neighbouring batches are not merged; the size of a piece depends on its rows alone.
    """
    for batch in batches:
        values = batch.column(batch.schema.get_field_index(column))
        if not len(values):
            continue
        lengths = pc.fill_null(pc.binary_length(values), 0).to_numpy(
            zero_copy_only=False
        )
        start, held = 0, 0
        for i, n in enumerate(lengths):
            if i > start and held + n > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(n)
        yield batch.slice(start)
