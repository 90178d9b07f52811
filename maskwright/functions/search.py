"""Looking for many values in one text at once."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Up to this many characters, values times text length, each value is looked for by itself.
DIRECT = 8_000_000


def found_in(text: str, values: list[str | None]) -> list[bool | None]:
    """Whether each value occurs in a text, which is read once for all of them."""
    import ahocorasick

    places: dict[str, list[int]] = {}
    for i, value in enumerate(values):
        if value is not None:
            places.setdefault(value, []).append(i)
    out: list[bool | None] = [None if v is None else v == "" for v in values]
    known = ahocorasick.Automaton()
    for value in places:
        if value:
            known.add_word(value, value)
    if not len(known):
        return out
    known.make_automaton()
    # A match reports the values that end it, too, so one that hides in a longer one is not missed.
    waiting = set(places) - {""}
    for _, value in known.iter(text):
        if value in waiting:
            waiting.discard(value)
            for i in places[value]:
                out[i] = True
            if not waiting:
                break
    return out


def _searched(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for texts, lists in batches:
        yield pd.Series(
            [
                None if text is None or values is None else found_in(text, list(values))
                for text, values in zip(texts, lists)
            ]
        )


def occurring(text: Column, values: Column) -> Column:
    """For each of an array's values whether it occurs in the text.

    A few values are looked for one after the other. That reads the text once for each, so rows in
    which it would take longer than a pass in Python are searched there for all values at once, by
    an automaton of the row's own values. All other rows hand Python nothing but nulls.
    """
    many = F.size(values).cast("long") * F.length(text) > DIRECT
    at_once = F.pandas_udf(_searched, "array<boolean>")(F.when(many, text), F.when(many, values))
    return F.when(many, at_once).otherwise(F.transform(values, lambda v: F.contains(text, v)))
