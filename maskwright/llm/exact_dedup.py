"""Exact deduplication by skew-safe combining.

Texts are equal when they are identical after lower-casing A-Z. Combining takes three steps, and
each compares whole texts, not digests:

1. each task deduplicates what it has read (the partial aggregation);
2. what is left is merged for each digest, text and salt;
3. the winners of the salts are merged for each digest and text.

A group of copies therefore costs one row for each task and then one for each salt, however large
it is. The groups are written without their texts. A document finds its group by the digest; if
two different texts share one, step 3 has left two groups for it, and the documents of that digest
alone find theirs by the text.

Defined results: a null text counts as empty. Rows that repeat a doc_id and a text get the same
row of the result, each. A null id never wins over another; a group of null ids only has the
keep_id null, and its rows are kept. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskwright.llm.common import lower_ascii
from maskwright.sources.staging import stage

SALTS = 16

Digest = Callable[[Column], Column]


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def keyed(docs: DataFrame, id_col: str, text_col: str, digest: Digest) -> DataFrame:
    """Ids with their normalised texts and digests."""
    norm = lower_ascii(F.coalesce(F.col(text_col), F.lit("")))
    return docs.select(F.col(id_col).alias("id"), norm.alias("norm")).withColumn(
        "digest", digest(F.col("norm"))
    )


def combine(rows: DataFrame, salts: int) -> DataFrame:
    """One row for each text: ``digest, norm, keep_id, group_size``."""
    salt = F.pmod(F.xxhash64("id"), F.lit(salts))
    merged = rows.groupBy("digest", "norm", salt.alias("salt")).agg(
        F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    return merged.groupBy("digest", "norm").agg(
        F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
    )


def groups_of(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = SALTS,
    digest: Digest = sha256,
) -> tuple[DataFrame, DataFrame | None]:
    """The groups without texts, and with texts those whose digest is not theirs alone (or None)."""
    rows = keyed(docs, id_col, text_col, digest)
    groups = stage(
        combine(rows, salts).select("digest", "keep_id", "group_size"), "exact-groups"
    )
    shared = groups.groupBy("digest").count().where("count > 1").select("digest")
    if shared.isEmpty():
        return groups, None
    return groups.join(shared, "digest", "left_anti"), combine(
        rows.join(shared, "digest", "left_semi"), salts
    )


def assign(rows: DataFrame, groups: DataFrame, shared: DataFrame | None) -> DataFrame:
    """Add ``keep_id`` and ``group_size`` to rows that have ``digest`` and ``norm``."""
    own = rows.join(groups, "digest")
    if shared is None:
        return own
    return own.unionByName(rows.join(shared, ["digest", "norm"]).select(*own.columns))


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = SALTS,
    digest: Digest = sha256,
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    groups, shared = groups_of(docs, id_col, text_col, salts, digest)
    rows = keyed(docs, id_col, text_col, digest).withColumn("sha", sha256(F.col("norm")))
    if shared is None:
        rows = rows.drop("norm")
    return assign(rows, groups, shared).select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def deduplicated(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS
) -> DataFrame:
    """The documents that stay, with all their columns; a row that repeats id and text stays once."""
    groups, shared = groups_of(docs, id_col, text_col, salts)
    norm = lower_ascii(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), norm.alias("norm"))
    rows = rows.withColumn("digest", sha256(F.col("norm")))
    if shared is None:
        rows = rows.drop("norm")
    kept = assign(rows, groups, shared).where(F.col("id").eqNullSafe(F.col("keep_id")))
    return kept.dropDuplicates(["digest", "keep_id", "group_size"]).select("row.*")
