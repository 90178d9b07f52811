"""Masked rows and their vault as two tables with one layout, so that they are joined in place.

Both tables are bucketed by workspace and mapping id. Restoring, and looking for rows without a mapping
or for mappings without a row, then reads the buckets side by side and shuffles neither table. Where
the layouts differ, or a table is not bucketed, Spark shuffles as for any other join: the results are
the same. A mapping id that very many rows share is one bucket's; ``restore_with_mapping`` lets Spark
split it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskwright.functions.catalogue import PREEXISTING_RE
from maskwright.operators.mask import WORKSPACE_FIELD, mask_with_vault, take_apart
from maskwright.operators.restore import restore_joined
from maskwright.sources.staging import staged

KEYS = ["workspace_id", "mapping_id"]


def _save(df: DataFrame, table: str, buckets: int, path: str | None, mode: str) -> None:
    """One file per bucket: rows are dealt out as the buckets are."""
    writer = df.repartition(buckets, *KEYS).write.mode(mode).bucketBy(buckets, *KEYS).sortBy(*KEYS)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def write_masked_tables(
    df: DataFrame,
    masked_table: str,
    vault_table: str,
    text: str,
    key: list[str],
    buckets: int,
    workspace: str | Column | None = None,
    policy: str = "balanced",
    output_field: str = "masked",
    on_error: str = "fail",
    mode: str = "error",
    paths: tuple[str, str] | None = None,
    stage_path: str | None = None,
) -> None:
    """Mask a table into two bucketed ones, matching once; the vault is written first.

    The masked table has ``workspace_id`` and ``mapping_id`` as columns of their own. ``paths`` are
    the tables' folders, if the warehouse is not the place for them. Choose ``buckets`` so that one
    bucket of either table fits a task.
    """
    taken = {c.lower() for c in df.columns} & set(KEYS)
    if taken:
        raise ValueError(f"columns {sorted(taken)} are those of the vault's key")
    masked_path, vault_path = paths or (None, None)
    both = mask_with_vault(df, text, key, workspace, policy, output_field, on_error)
    with staged(both, "masked", stage_path) as rows:
        _, vault = take_apart(rows, output_field)
        keyed = rows.withColumns(
            {"workspace_id": F.col(WORKSPACE_FIELD), "mapping_id": F.col(f"{output_field}.mapping_id")}
        )
        _save(vault.dropDuplicates(KEYS), vault_table, buckets, vault_path, mode)
        _save(take_apart(keyed, output_field)[0], masked_table, buckets, masked_path, mode)


def restore_tables(
    masked: DataFrame,
    vault: DataFrame,
    text: str | Column = "masked.masked_text",
    output_field: str = "restored",
    on_error: str = "fail",
) -> DataFrame:
    """Restore rows that have the vault's key as columns."""
    entities = F.arrays_zip(
        F.col("entities.placeholder").alias("placeholder"), F.col("entities.original").alias("original")
    )
    found = vault.select(*KEYS, entities.alias("__mw_entities"))
    return restore_joined(masked.join(found, KEYS, "left"), text, "mapping_id", output_field, on_error)


def orphan_rows(
    masked: DataFrame, vault: DataFrame, text: str | Column = "masked.masked_text"
) -> DataFrame:
    """Masked rows that hold placeholders but have no mapping."""
    body = F.col(text) if isinstance(text, str) else text
    holding = masked.where(F.rlike(body, F.lit(PREEXISTING_RE)))
    return holding.join(vault.select(*KEYS), KEYS, "left_anti")


def unused_rows(masked: DataFrame, vault: DataFrame) -> DataFrame:
    """Mappings that no masked row refers to. Ids are made distinct within their buckets."""
    return vault.join(masked.select(*KEYS).distinct(), KEYS, "left_anti")
