"""Put original values back into masked text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from maskwright.functions import placeholders, rows
from maskwright.functions.arrays import bind, evaluated_once

RESTORE_TEXT = "__mw_masked_text"
PAIRS = "__mw_pairs"
PUT_BACK = "__mw_put_back"
UNKNOWN = "__mw_unknown"


def restored(df: DataFrame, text: Column, pairs: Column) -> DataFrame:
    """Add masked text, restored text and unknown placeholders as working columns."""
    out = evaluated_once(df, {RESTORE_TEXT: text, PAIRS: pairs})
    both = bind(
        placeholders.restore_text(F.col(RESTORE_TEXT), F.col(PAIRS)),
        lambda t: F.struct(
            t.alias(PUT_BACK), placeholders.hallucinated(t, F.col(PAIRS)).alias(UNKNOWN)
        ),
    )
    return evaluated_once(out, both)


def _emit(
    df: DataFrame, output_field: str, problems: list[tuple[Column, str]], on_error: str
) -> DataFrame:
    output = F.struct(
        F.col(PUT_BACK).alias("restored_text"),
        F.col(UNKNOWN).alias("hallucinated"),
        F.lit(rows.SOURCE).alias("source"),
    )
    empty = (~rows.is_filled(F.col(RESTORE_TEXT)), rows.TEXT_EMPTY)
    out = rows.emit(df, output_field, output, [empty, *problems], on_error)
    return out.drop(*[c for c in out.columns if c.startswith("__mw_")])


def restore(
    df: DataFrame,
    text: str | Column = "text",
    entities: str | Column = "entities",
    output_field: str = "restored",
    on_error: str = "fail",
) -> DataFrame:
    """Restore from an entity list in the row: an array of records, or the same as JSON text.

    Records without a text as placeholder or original are left out, so a list of public entities
    restores nothing.
    """
    listed = rows.as_column(entities)
    kind = df.select(listed.alias("e")).schema["e"].dataType
    if isinstance(kind, StringType):
        pairs = placeholders.pairs_from_json(listed)
    else:
        record = kind.elementType if isinstance(kind, ArrayType) else None
        texts = {f.name for f in getattr(record, "fields", []) if isinstance(f.dataType, StringType)}
        usable = {"placeholder", "original"} <= texts
        pairs = placeholders.pairs_from_array(listed) if usable else placeholders.no_pairs()
    return _emit(restored(df, rows.as_column(text), pairs), output_field, [], on_error)


def grouped_mapping(mapping: DataFrame) -> DataFrame:
    """A one-row-per-placeholder mapping as a vault: one row per mapping id.

    Rows that repeat each other become one in each task already. Of different originals for a
    placeholder the first in the text comes first in the list, and so is the one that restoring
    puts back.
    """
    keys = ["workspace_id", "mapping_id"]
    record = F.struct("start", "category", "placeholder", "original", "end")
    return (
        mapping.groupBy(*keys)
        .agg(F.array_sort(F.collect_set(record)).alias("e"))
        .select(
            *keys,
            F.transform(
                "e",
                lambda e: F.struct(
                    e["category"].alias("category"),
                    e["placeholder"].alias("placeholder"),
                    e["original"].alias("original"),
                    e["start"].alias("start"),
                    e["end"].alias("end"),
                ),
            ).alias("entities"),
        )
    )


def with_vault(
    df: DataFrame,
    vault: DataFrame,
    mapping_id: Column,
    workspace: Column,
    spread: Column,
    fields: tuple[str, ...] = ("placeholder", "original"),
) -> DataFrame:
    """Left equi join of masked rows with their entities, as ``__mw_entities``.

    Only the given fields of the entities are read from the vault and shuffled.

    Rows without an id cannot match. They would all meet in one partition, so their join key
    is spread by ``spread`` instead. A mapping id shared by many rows is split by Spark's
    adaptive skew join, which needs both sides to come straight from a shuffle or a scan:
    nothing is grouped here.
    """
    has_id = rows.is_filled(mapping_id)
    left = df.withColumns(
        {
            "__mw_ws": F.when(has_id, workspace),
            "__mw_id": F.when(has_id, mapping_id).otherwise(
                F.xxhash64(spread).cast("string")
            ),
        }
    )
    right = vault.select(
        F.col("workspace_id").alias("__mw_ws"),
        F.col("mapping_id").alias("__mw_id"),
        F.arrays_zip(*[F.col(f"entities.{f}").alias(f) for f in fields]).alias("__mw_entities"),
    )
    return left.join(right, ["__mw_ws", "__mw_id"], "left").drop("__mw_ws", "__mw_id")


def restore_with_mapping(
    df: DataFrame,
    vault: DataFrame,
    text: str | Column = "text",
    mapping_id: str | Column = "mapping_id",
    workspace: str | Column | None = None,
    output_field: str = "restored",
    on_error: str = "fail",
) -> DataFrame:
    """Restore by mapping id. A workspace never sees another workspace's mapping.

    ``vault`` has one row per mapping id (see ``vault_rows``), or one per placeholder. All
    columns of ``df`` are kept; row order is not, so keep a key.
    """
    if "entities" not in vault.columns:
        vault = grouped_mapping(vault)
    out = df.withColumns(
        {"__mw_body": rows.as_column(text), "__mw_given_id": rows.as_column(mapping_id)}
    )
    out = with_vault(
        out, vault, F.col("__mw_given_id"), rows.workspace(workspace), F.col("__mw_body")
    )
    return restore_joined(out, F.col("__mw_body"), F.col("__mw_given_id"), output_field, on_error)


def restore_joined(
    df: DataFrame,
    text: str | Column,
    mapping_id: str | Column,
    output_field: str,
    on_error: str,
) -> DataFrame:
    """Restore rows that their entities have been joined to, as ``__mw_entities``."""
    pairs = placeholders.pairs_from_array(F.col("__mw_entities"))
    out = df.withColumn("__mw_given_id", rows.as_column(mapping_id))
    out = restored(out, rows.as_column(text), pairs)
    missing = (~rows.is_filled(F.col("__mw_given_id")), rows.MAPPING_ID_EMPTY)
    return _emit(out, output_field, [missing], on_error)
