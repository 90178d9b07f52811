"""Chat messages around masked text: building requests and reading answers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from maskwright.functions.catalogue import _BLANK
from maskwright.functions.rows import as_column

CUSTOM_MODEL = "__custom__"  # fixed value: selects the free-form model id


def _value(value: str | Column | None) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def build_messages(prompt: str | Column, system: str | Column | None = None) -> Column:
    """``[system, user]`` messages. The system text is never masked, and left out if empty."""

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    user = F.array(message("user", as_column(prompt)))
    if system is None:
        return user
    text = _value(system)
    return F.when(
        F.coalesce(text != "", F.lit(False)), F.concat(F.array(message("system", text)), user)
    ).otherwise(user)


def first_choice(completion: str | Column) -> Column:
    """Text of the first choice in a chat completion's JSON; empty if there is none."""
    return F.coalesce(
        F.get_json_object(as_column(completion), "$.choices[0].message.content"), F.lit("")
    )


def resolve_model(model: str | Column, custom: str | Column | None = None) -> Column:
    """Model to call: the one picked, or the trimmed free-form id. Strings are literal names."""
    picked = _value(model)
    free = F.regexp_replace(
        _value(custom if custom is not None else ""), rf"^[{_BLANK}]+|[{_BLANK}]+$", ""
    )
    return F.when(picked == CUSTOM_MODEL, free).otherwise(picked)
