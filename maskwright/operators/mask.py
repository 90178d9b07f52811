"""Replace personal data by numbered placeholders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from maskwright.functions import rows
from maskwright.functions.arrays import bind, evaluated_once
from maskwright.functions.catalogue import CATEGORIES, PATTERN_CONFIDENCE, POLICIES
from maskwright.functions.spans import (
    TEXT,
    entities,
    hits_in_order,
    match_column,
    spans,
    splice,
    with_matches,
)

SPANS = "__mw_spans"
MASKED = "__mw_masked"
MAPPING_ID = "__mw_mapping_id"
WORKSPACE = "__mw_workspace"
ENTITIES_FIELD = "__entities"
WORKSPACE_FIELD = "__workspace"


def public_entities(entities_: Column) -> Column:
    """Entities as they may leave: no original value, no position."""
    return F.transform(
        entities_,
        lambda e: F.struct(
            e["placeholder"].alias("placeholder"),
            e["category"].alias("category"),
            F.lit(PATTERN_CONFIDENCE).alias("confidence"),
        ),
    )


def _spans_and_masked() -> Column:
    """The span expression; it reads working columns only."""
    return bind(
        spans(hits_in_order(F.col(TEXT))),
        lambda s: F.struct(s.alias(SPANS), splice(F.col(TEXT), s).alias(MASKED)),
    )


def with_spans(df: DataFrame, text: str | Column) -> DataFrame:
    """Add the text, its numbered spans and its masked form as working columns."""
    out = with_matches(df, rows.as_column(text))
    return evaluated_once(out, _spans_and_masked()).drop(*[match_column(c) for c in CATEGORIES])


def mask(
    df: DataFrame,
    text: str | Column = "text",
    key: list[str] | None = None,
    workspace: str | Column | None = None,
    policy: str = "balanced",
    output_field: str = "masked",
    on_error: str = "fail",
    entities_field: str | None = None,
    workspace_field: str | None = None,
) -> DataFrame:
    """Add masked text, mapping id, public entities, policy and source; keep every column.

    Pattern masking has no thresholds, so ``policy`` is checked and echoed only. With
    ``entities_field`` the records that hold the original values are added as a column of
    their own: take them out with :func:`vault_rows` before the masked table is handed on.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}, got {policy!r}")
    space = rows.workspace(workspace)
    # The id reads the caller's columns, so it is taken before any of them can be replaced.
    out = with_spans(
        df.withColumns({MAPPING_ID: rows.mapping_id(space, key, text), WORKSPACE: space}), text
    )
    output = F.struct(
        F.col(MASKED).alias("masked_text"),
        F.col(MAPPING_ID).alias("mapping_id"),
        public_entities(F.col(SPANS)).alias("entities"),
        F.lit(policy).alias("policy"),
        F.lit(rows.SOURCE).alias("source"),
    )
    problems = [(~rows.is_filled(F.col(TEXT)), rows.MASK_TEXT_EMPTY)]
    out = rows.emit(out, output_field, output, problems, on_error, key)
    if entities_field:
        out = out.withColumn(entities_field, entities(F.col(SPANS)))
    if workspace_field:
        out = out.withColumn(workspace_field, F.col(WORKSPACE))
    return out.drop(*[c for c in out.columns if c.startswith("__mw_")])


def with_mapping_id(
    df: DataFrame,
    text: str | Column = "text",
    key: list[str] | None = None,
    workspace: str | Column | None = None,
    output_field: str = "mapping_id",
    on_error: str = "fail",
) -> DataFrame:
    """Add the mapping id that :func:`mask` gives a row, without matching its text."""
    output = rows.mapping_id(rows.workspace(workspace), key, text)
    problems = [(~rows.is_filled(rows.as_column(text)), rows.MASK_TEXT_EMPTY)]
    return rows.emit(df, output_field, output, problems, on_error, key)


def vault_rows(
    df: DataFrame,
    text: str | Column = "text",
    key: list[str] | None = None,
    workspace: str | Column | None = None,
    on_error: str = "fail",
) -> DataFrame:
    """The protected side of masking: one row per text that holds personal data.

    workspace_id, mapping_id and the entities with their original values. Keeping a text's
    entities in one row means restoring is a plain equi join, with nothing to collect.
    """
    if not key:
        raise ValueError("a mapping can only be joined back later if its id comes from a key")
    space = rows.workspace(workspace)
    df = rows.checked(df, [(~rows.is_filled(rows.as_column(text)), rows.MASK_TEXT_EMPTY)], on_error, key)
    out = with_spans(
        df.select("*", rows.mapping_id(space, key, text).alias(MAPPING_ID), space.alias(WORKSPACE)),
        text,
    )
    return out.where(F.size(SPANS) > 0).select(
        F.col(WORKSPACE).alias("workspace_id"),
        F.col(MAPPING_ID).alias("mapping_id"),
        entities(F.col(SPANS)).alias("entities"),
    )


def mask_with_vault(
    df: DataFrame,
    text: str,
    key: list[str],
    workspace: str | Column | None = None,
    policy: str = "balanced",
    output_field: str = "masked",
    on_error: str = "fail",
) -> DataFrame:
    """Masked rows without the raw text column, with their vault side still attached.

    Stage or persist this, then take it apart with :func:`take_apart`, and the texts are
    matched once for both tables.
    """
    both = mask(
        df, text, key, workspace, policy, output_field, on_error,
        entities_field=ENTITIES_FIELD, workspace_field=WORKSPACE_FIELD,
    )
    return without_text(both, text)


def without_text(df: DataFrame, text: str) -> DataFrame:
    """Drop the raw text, a column or a field of one, spelled in any way that Spark takes."""
    strict = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    fold = (lambda n: n) if strict else str.lower
    whole = [c for c in df.columns if fold(c) == fold(text.strip("`"))]
    if whole:
        return df.drop(*whole)
    top, *fields = [part.strip("`") for part in text.split(".")]
    holders = [c for c in df.columns if fold(c) == fold(top)]
    if not holders or not fields:
        raise ValueError(f"{text!r} names no column, so its text cannot be taken out")
    # A struct whose last field goes, goes itself.
    path, kind = [holders[0]], df.schema[holders[0]].dataType
    depth = 1
    for part in fields:
        inner = {fold(f.name): f for f in kind.fields} if isinstance(kind, StructType) else {}
        if fold(part) not in inner:
            raise ValueError(f"{text!r} names no column, so its text cannot be taken out")
        if len(inner) > 1:
            depth = len(path) + 1
        path.append(inner[fold(part)].name)
        kind = inner[fold(part)].dataType
    if depth == 1:
        return df.drop(holders[0])
    name = ".".join(f"`{part}`" for part in path[1:depth])
    return df.withColumn(holders[0], F.col(f"`{holders[0]}`").dropFields(name))


def take_apart(both: DataFrame, output_field: str = "masked") -> tuple[DataFrame, DataFrame]:
    """Masked rows and vault rows from what :func:`mask_with_vault` gave."""
    vault = both.where(F.size(ENTITIES_FIELD) > 0).select(
        F.col(WORKSPACE_FIELD).alias("workspace_id"),
        F.col(f"{output_field}.mapping_id").alias("mapping_id"),
        F.col(ENTITIES_FIELD).alias("entities"),
    )
    return both.drop(ENTITIES_FIELD, WORKSPACE_FIELD), vault


def mapping_rows(vault: DataFrame) -> DataFrame:
    """A vault as one row per placeholder."""
    return vault.select("workspace_id", "mapping_id", F.inline("entities")).select(
        "workspace_id", "mapping_id", "placeholder", "category", "original", "start", "end"
    )


def mask_entities(
    df: DataFrame,
    text: str | Column = "text",
    key: list[str] | None = None,
    workspace: str | Column | None = None,
    on_error: str = "fail",
) -> DataFrame:
    """One row per masked value, with its placeholder and position."""
    return mapping_rows(vault_rows(df, text, key, workspace, on_error))
