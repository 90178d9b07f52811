"""Masking and restoring on streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import DataStreamWriter

from maskwright.operators.mask import mask_with_vault, take_apart
from maskwright.sources.vault import compact_vault, write_batch

# Masking keeps no state: `operators.mask.mask` and `operators.detect.detect` can be applied to
# a streaming frame as they are, in append mode. What a stream adds is the second output.


def mask_stream(
    df: DataFrame,
    masked_path: str,
    vault_path: str,
    checkpoint: str,
    text: str,
    key: list[str],
    workspace: str | Column | None = None,
    policy: str = "balanced",
    output_field: str = "masked",
    on_error: str = "keep",
    compact_every: int | None = None,
) -> DataStreamWriter:
    """Stream writer that fills a masked table and a vault; call ``start()`` on it.

    Each micro-batch writes its mapping first, then its masked rows, both into a folder named
    after the batch. A replayed batch overwrites its own folders. Rows that repeat key and text share a
    mapping id: a batch writes their mapping once, and ``read_vault`` takes it once from all
    batches, so as many rows are restored as came in. With ``compact_every`` the vault's batches
    are merged after that many, which bounds the number of its files.
    """
    both = mask_with_vault(df, text, key, workspace, policy, output_field, on_error)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            masked, vault = take_apart(batch, output_field)
            write_batch(vault, vault_path, batch_id)
            masked.write.mode("overwrite").parquet(f"{masked_path}/batch_id={batch_id}")
            if compact_every and (batch_id + 1) % compact_every == 0:
                compact_vault(batch.sparkSession, vault_path)
        finally:
            batch.unpersist()

    return both.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
