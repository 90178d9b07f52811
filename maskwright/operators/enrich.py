"""Let outside code work on masked text only, and restore its answer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskwright.functions import placeholders, rows
from maskwright.functions.messages import resolve_model
from maskwright.functions.spans import TEXT
from maskwright.operators.mask import MAPPING_ID, MASKED, SPANS, with_spans
from maskwright.operators.restore import PUT_BACK, RESTORE_TEXT, UNKNOWN, restored

MODEL = "__mw_model"


def _prepared(df, text, key, workspace, model, custom_model) -> DataFrame:
    space = rows.workspace(workspace)
    out = df.withColumns(
        {MAPPING_ID: rows.mapping_id(space, key, text), MODEL: resolve_model(model, custom_model)}
    )
    return with_spans(out, text)


def _finished(df: DataFrame, answer: Column, output_field: str, on_error: str) -> DataFrame:
    out = restored(df, answer, placeholders.pairs_from_array(F.col(SPANS)))
    output = F.struct(
        F.col(PUT_BACK).alias("response"),
        F.col(MASKED).alias("masked_prompt"),
        F.col(RESTORE_TEXT).alias("masked_response"),
        F.col(MAPPING_ID).alias("mapping_id"),
        F.col(MODEL).alias("model"),
        F.col(UNKNOWN).alias("hallucinated"),
        F.lit(rows.SOURCE).alias("source"),
    )
    problems = [
        (~rows.is_filled(F.col(MODEL)), rows.MODEL_EMPTY),
        (~rows.is_filled(F.col(TEXT)), rows.PROMPT_EMPTY),
    ]
    out = rows.emit(out, output_field, output, problems, on_error)
    return out.drop(*[c for c in out.columns if c.startswith("__mw_")])


def private_enrich(
    df: DataFrame,
    text: str | Column,
    enrich: Callable[[DataFrame], DataFrame],
    key: list[str],
    model: str | Column = "none",
    custom_model: str | Column | None = None,
    workspace: str | Column | None = None,
    output_field: str = "enriched",
    on_error: str = "fail",
    stage: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Mask, hand ``(mapping_id, model, masked_prompt)`` to ``enrich``, restore its answer.

    ``enrich`` returns ``mapping_id`` and ``masked_response``, one row per id (a second one ends the
    run, since it would multiply rows); a row it does not answer gets an empty response. It never sees an original value. Pass
    ``sources.staging.stage`` (bound to a session) as ``stage`` to write the masked rows once,
    so that masking is not repeated for the two sides of the join.
    """
    if not key:
        raise ValueError("answers can only be joined back if ids come from a key")
    out = _prepared(df, text, key, workspace, model, custom_model)
    if stage is not None:
        out = stage(out)
    # Refused rows are not sent out.
    sent = out.where(rows.is_filled(F.col(TEXT)) & rows.is_filled(F.col(MODEL))).select(
        F.col(MAPPING_ID).alias("mapping_id"),
        F.col(MODEL).alias("model"),
        F.col(MASKED).alias("masked_prompt"),
    ).distinct()
    several = F.raise_error(F.lit("More than one answer for a mapping id.")).cast("string")
    answers = (
        enrich(sent)
        .groupBy(F.col("mapping_id").alias(MAPPING_ID))
        .agg(F.first("masked_response").alias("one"), F.count(F.lit(1)).alias("n"))
        .select(MAPPING_ID, F.when(F.col("n") > 1, several).otherwise(F.col("one")).alias("__mw_answer"))
    )
    joined = out.join(answers, MAPPING_ID, "left")
    answer = F.coalesce(F.col("__mw_answer"), F.lit(""))
    return _finished(joined, answer, output_field, on_error)


def private_enrich_column(
    df: DataFrame,
    text: str | Column,
    enrich: Callable[[Column], Column],
    key: list[str] | None = None,
    model: str | Column = "none",
    custom_model: str | Column | None = None,
    workspace: str | Column | None = None,
    output_field: str = "enriched",
    on_error: str = "fail",
) -> DataFrame:
    """The same with a column function, such as a pandas UDF: no join and no shuffle."""
    out = _prepared(df, text, key, workspace, model, custom_model)
    answer = F.coalesce(enrich(F.col(MASKED)), F.lit(""))
    return _finished(out, answer, output_field, on_error)
