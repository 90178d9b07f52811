"""Find personal data without changing the text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskwright.functions import rows
from maskwright.functions.arrays import bind, evaluated_once
from maskwright.functions.catalogue import MAX_SAMPLES, Category, wanted
from maskwright.functions.spans import TEXT, hits_in_order, match_column, with_matches

FOUND = "__mw_found"
FOUND_TYPE = "struct<category:string,count:int,samples:array<string>>"


def _working(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("__mw_")]


def _valid(category: Category) -> Column:
    """Matches of a category after its checksum. Those of different categories may overlap."""
    return category.keep_valid(F.col(match_column(category)))


def hits(
    df: DataFrame,
    text: str | Column = "text",
    categories=None,
    output_field: str = "hits",
    on_error: str = "fail",
) -> DataFrame:
    """Add all valid hits with positions, overlapping ones included, in text order.

    A null or empty text ends the run, is left out (``skip``), or has no hits (``keep``). This holds
    for all operators here that return rows of hits or counts.
    """
    out = with_matches(rows.with_text(df, text, on_error), rows.as_column(text), categories)
    out = evaluated_once(out, {"__mw_hits": hits_in_order(F.col(TEXT), categories)})
    out = out.withColumn(output_field, F.col("__mw_hits"))
    return out.drop(*_working(out))


def hits_long(
    df: DataFrame, text: str | Column = "text", categories=None, on_error: str = "fail"
) -> DataFrame:
    """One row per valid hit: all input columns plus start, category, raw and end."""
    out = with_matches(rows.with_text(df, text, on_error), rows.as_column(text), categories)
    out = evaluated_once(out, {"__mw_hits": hits_in_order(F.col(TEXT), categories)})
    out = out.withColumn("__mw_hit", F.explode("__mw_hits"))
    return out.select(
        *[c for c in out.columns if not c.startswith("__mw_")],
        F.col("__mw_hit.category").alias("category"),
        F.col("__mw_hit.raw").alias("raw"),
        F.col("__mw_hit.start").alias("start"),
        F.col("__mw_hit.end").alias("end"),
    )


def _found(category: Category, include_samples: bool) -> Column:
    def record(matches: Column) -> Column:
        samples = (
            F.slice(matches, 1, MAX_SAMPLES)
            if include_samples
            else F.array().cast("array<string>")
        )
        return F.struct(
            F.lit(category.name).alias("category"),
            F.size(matches).alias("count"),
            samples.alias("samples"),
        )

    valid = _valid(category)
    return record(valid) if category.check is None else bind(valid, record)


def with_found(
    df: DataFrame, text: Column, categories=None, include_samples: bool = True
) -> DataFrame:
    """Add the text and its found categories, in catalogue order, as working columns."""
    out = with_matches(df, text, categories)
    cats = wanted(categories)
    found = F.array().cast(f"array<{FOUND_TYPE}>")
    if cats:
        any_match = sum((F.size(match_column(c)) for c in cats), F.lit(0)) > 0
        records = F.array(*[_found(c, include_samples) for c in cats])
        found = F.when(any_match, F.filter(records, lambda f: f["count"] > 0)).otherwise(found)
    return evaluated_once(out, {FOUND: found})


def detect(
    df: DataFrame,
    text: str | Column = "text",
    categories=None,
    include_samples: bool = True,
    output_field: str = "pii",
    on_error: str = "fail",
) -> DataFrame:
    """Add ``found_pii`` (category, count, up to 3 samples), ``total_count`` and ``source``."""
    out = with_found(df, rows.as_column(text), categories, include_samples)
    total = F.aggregate(FOUND, F.lit(0), lambda n, f: n + f["count"])
    output = F.struct(
        F.col(FOUND).alias("found_pii"),
        total.alias("total_count"),
        F.lit(rows.SOURCE).alias("source"),
    )
    out = rows.emit(
        out, output_field, output, [(~rows.is_filled(F.col(TEXT)), rows.TEXT_EMPTY)], on_error
    )
    return out.drop(*_working(out))


def count_columns(
    df: DataFrame,
    text: str | Column = "text",
    categories=None,
    prefix: str = "n_",
    on_error: str = "fail",
) -> DataFrame:
    """Add one count column per wanted category; the cheapest form, for aggregation."""
    cats = wanted(categories)
    out = with_matches(rows.with_text(df, text, on_error), rows.as_column(text), categories)
    out = out.withColumns({f"{prefix}{c.name.lower()}": F.size(_valid(c)) for c in cats})
    return out.drop(*_working(out))


def detect_counts(
    df: DataFrame,
    key: list[str],
    text: str | Column = "text",
    categories=None,
    on_error: str = "fail",
) -> DataFrame:
    """One row per input row and category that occurs: key, category, hits.

    The counts of a row are known in the row, so nothing is shuffled.
    """
    checked = rows.with_text(df, text, on_error, key)
    out = with_found(checked, rows.as_column(text), categories, include_samples=False)
    out = out.select(*key, F.explode(FOUND).alias("f"))
    return out.select(
        *key,
        F.col("f.category").alias("category"),
        F.col("f.count").cast("bigint").alias("hits"),
    )


def detect_samples(
    df: DataFrame,
    key: list[str],
    text: str | Column = "text",
    categories=None,
    on_error: str = "fail",
) -> DataFrame:
    """First three raw matches per row and category: key, category, rank, sample."""
    out = with_found(rows.with_text(df, text, on_error, key), rows.as_column(text), categories)
    return (
        out.select(*key, F.explode(FOUND).alias("f"))
        .select(*key, "f.category", F.posexplode("f.samples").alias("rank", "sample"))
        .withColumn("rank", (F.col("rank") + 1).cast("bigint"))
    )
