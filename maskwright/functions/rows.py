"""Rules that every row-wise operator shares: bad rows, workspace, mapping id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Messages of refused rows and the default workspace.
MASK_TEXT_EMPTY = (
    "Text is empty: name a column that holds text, or keep such rows with on_error."
)
TEXT_EMPTY = "Text is empty."
PROMPT_EMPTY = "Prompt is empty."
MODEL_EMPTY = "Model is empty — pick one or fill Custom Model ID."
MAPPING_ID_EMPTY = "Mapping ID is required."
DEFAULT_WORKSPACE = "default"
SOURCE = "regex"

ON_ERROR = ("fail", "keep", "skip")


def as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def is_filled(value: Column) -> Column:
    """True for a non-empty string; null counts as empty."""
    return F.coalesce(value != "", F.lit(False))


def workspace(*choices: str | Column | None) -> Column:
    """First choice that is set and not empty, else the default workspace.

    A string is taken as the workspace's name, a Column as a per-row value.
    """
    options = [c if isinstance(c, Column) else F.lit(c) for c in choices if c is not None]
    return F.coalesce(*[F.nullif(o, F.lit("")) for o in options], F.lit(DEFAULT_WORKSPACE))


def mapping_id(
    workspace_: Column, key: list[str | Column] | None, text: str | Column
) -> Column:
    """Id that ties masked text to its mapping.

    With a key the id is the same on every recomputation, retry and replay, which is what a
    later join needs. It covers the text, so rows that repeat a key, or have none, share an id
    only if they share all that the mapping holds. Without a key it is random, and the masked
    table must be written before anything else is derived from it.
    """
    if not key:
        return F.expr("uuid()")
    named = [as_column(k).alias(f"k{i}") for i, k in enumerate(key)]
    # A null text is told apart from an empty one.
    body = F.coalesce(F.sha2(as_column(text).cast("binary"), 256), F.lit("")).alias("t")
    return F.sha2(F.to_json(F.struct(workspace_.alias("w"), *named, body)), 256)


def _named(message: Column, key: list[str | Column] | None) -> Column:
    """The message and the key of the row that it is about."""
    if not key:
        return message
    named = F.struct(*[as_column(k).alias(k if isinstance(k, str) else f"k{i}") for i, k in enumerate(key)])
    return F.concat(message, F.lit(" Row "), F.to_json(named))


def checked(
    df: DataFrame,
    problems: list[tuple[Column, str]],
    on_error: str,
    key: list[str | Column] | None = None,
) -> DataFrame:
    """The rows without problems: others end the run (``fail``) or are left out (``skip``).

    With ``keep`` all rows stay. The message of an ended run names the key of its first bad row.
    """
    if on_error not in ON_ERROR:
        raise ValueError(f"on_error must be one of {ON_ERROR}, got {on_error!r}")
    if on_error == "keep":
        return df
    message = F.coalesce(*[F.when(bad, F.lit(text)) for bad, text in problems])
    # A filter, so that the rows are checked whatever is selected; it reads the text's column.
    refused = F.lit(False)
    if on_error == "fail":
        refused = F.raise_error(_named(message, key)).cast("boolean")
    return df.where(F.when(message.isNotNull(), refused).otherwise(True))


def with_text(
    df: DataFrame, text: str | Column, on_error: str, key: list[str | Column] | None = None
) -> DataFrame:
    """:func:`checked` for the one rule of operators that read a text."""
    return checked(df, [(~is_filled(as_column(text)), TEXT_EMPTY)], on_error, key)


def emit(
    df: DataFrame,
    output_field: str,
    output: Column,
    problems: list[tuple[Column, str]],
    on_error: str,
    key: list[str | Column] | None = None,
) -> DataFrame:
    """Add ``output``; rows with a problem end the run, are left out, or carry an ``error`` text."""
    if on_error != "keep":
        return checked(df, problems, on_error, key).withColumn(output_field, output)
    message = F.coalesce(*[F.when(bad, F.lit(text)) for bad, text in problems])
    earlier = F.col("error") if "error" in df.columns else F.lit(None).cast("string")
    return df.withColumns(
        {
            output_field: F.when(message.isNull(), output),
            "error": F.coalesce(message, earlier),
        }
    )
