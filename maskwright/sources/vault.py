"""The mapping store: originals, kept apart from the masked data.

One row per masked text, partitioned by workspace, so that reading one workspace never opens
another one's files.

A stream writes a folder per batch. A mapping id covers workspace, key and text, so rows that come again
in a later batch bring the same mapping again. Readers take each id once, and `compact_vault` merges
finished batches into one table without repetitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from maskwright.operators.mask import ENTITIES_FIELD, WORKSPACE_FIELD, mask_with_vault, take_apart
from maskwright.sources.files import children, is_complete, remove
from maskwright.sources.staging import staged

ENTITY_TYPE = (
    "struct<category:string,placeholder:string,original:string,start:int,end:int>"
)
KEYS = ["workspace_id", "mapping_id"]
SCHEMA = f"workspace_id string, mapping_id string, entities array<{ENTITY_TYPE}>"


BATCH = "batch_id="
MERGED = "merged_upto="


def write_vault(vault: DataFrame, path: str, mode: str = "error") -> None:
    """Write vault rows partitioned by workspace.

    The rebalance hint lets Spark size the files and split a workspace that holds most rows,
    instead of one small file per task and workspace. Equal texts under one key share an id, and
    their mapping is written once.
    """
    (
        vault.select(*KEYS, "entities")
        .dropDuplicates(KEYS)
        .hint("rebalance", "workspace_id")
        .write.mode(mode)
        .partitionBy("workspace_id")
        .parquet(path)
    )


def write_batch(vault: DataFrame, path: str, batch_id: int) -> None:
    """Write one batch of a stream into a folder of its own; a replay overwrites it."""
    write_vault(vault, f"{path}/{BATCH}{batch_id}", "overwrite")


def _numbers(spark: SparkSession, path: str, names: list[str], prefix: str) -> list[int]:
    """Numbers of the complete tables with a prefix, in order."""
    found = sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix))
    return [n for n in found if is_complete(spark, f"{path}/{prefix}{n}")]


def _parts(spark: SparkSession, path: str) -> tuple[int, list[int]]:
    """Up to which batch a vault of batches is merged (-1: none), and the batches after it."""
    names = children(spark, path)
    merged = max(_numbers(spark, path, names, MERGED), default=-1)
    return merged, [b for b in _numbers(spark, path, names, BATCH) if b > merged]


def _read(spark: SparkSession, *paths: str) -> DataFrame:
    empty = spark.createDataFrame([], SCHEMA)
    if not paths:
        return empty
    # Each folder by itself, since those of different kinds have different partition columns.
    parts = [spark.read.schema(SCHEMA).parquet(p).select(*KEYS, "entities") for p in paths]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def read_vault(spark: SparkSession, path: str, workspace: str | None = None) -> DataFrame:
    """Vault rows, of one workspace or of all, each mapping id once.

    What a batch table or a merged one holds is free of repetitions already; only batches that have
    not been merged yet are compared with the rest.
    """
    merged, later = _parts(spark, path)
    wanted = F.lit(True) if workspace is None else F.col("workspace_id") == workspace
    if merged < 0 and not later:
        return _read(spark, path).where(wanted)
    tail = _read(spark, *[f"{path}/{BATCH}{b}" for b in later]).where(wanted)
    if len(later) > 1:
        tail = tail.dropDuplicates(KEYS)
    if merged < 0:
        return tail
    old = _read(spark, f"{path}/{MERGED}{merged}").where(wanted)
    return old.unionByName(tail.join(old.select(*KEYS), KEYS, "left_anti")) if later else old


def compact_vault(spark: SparkSession, path: str) -> None:
    """Merge the batches of a stream's vault into one table, and delete them.

    Doing it again, or after it broke off, gives the same: a merged table counts once it is complete,
    and batches up to its number are not read any more, also if a replay writes one again. Every
    merge rewrites the vault, so call it now and then, not for each batch.
    """
    merged, later = _parts(spark, path)
    if later:
        write_vault(read_vault(spark, path), f"{path}/{MERGED}{later[-1]}", "overwrite")
        merged = later[-1]
    for name in children(spark, path):
        prefix = next((p for p in (BATCH, MERGED) if name.startswith(p)), None)
        if prefix is not None:
            number = int(name.removeprefix(prefix))
            if number < merged or (number == merged and prefix == BATCH):
                remove(spark, f"{path}/{name}")


def write_masked(
    df: DataFrame,
    masked_path: str,
    vault_path: str,
    text: str,
    key: list[str],
    workspace: str | Column | None = None,
    policy: str = "balanced",
    output_field: str = "masked",
    on_error: str = "fail",
    stage_path: str | None = None,
    mode: str = "error",
    rejects_path: str | None = None,
) -> dict[str, int]:
    """Mask a table into two: masked rows without the raw text column, and the vault.

    With ``rejects_path`` bad rows do not end the run but become a table of their own there, with
    the rule that they broke as ``error``. Returns how many rows were masked and rejected.

    Matching costs far more than writing, so it runs once, into a staged table that both
    outputs are read from. It holds originals and is deleted when both are written. The vault is
    written first: masked data without a mapping could not be restored.
    """
    rule = "keep" if rejects_path else on_error
    both = mask_with_vault(df, text, key, workspace, policy, output_field, rule)
    counts = Observation()
    bad = F.col("error").isNotNull() if rejects_path else F.lit(False)
    both = both.observe(
        counts, F.count_if(~bad).alias("masked"), F.count_if(bad).alias("rejected")
    )
    with staged(both, "masked", stage_path) as rows:
        if rejects_path:
            rejects = rows.where(bad).drop(ENTITIES_FIELD, WORKSPACE_FIELD, output_field)
            rejects.write.mode(mode).parquet(rejects_path)
            rows = rows.where(~bad).drop(*[c for c in ("error",) if c not in df.columns])
        masked, vault = take_apart(rows, output_field)
        write_vault(vault, vault_path, mode)
        masked.write.mode(mode).parquet(masked_path)
    return counts.get
