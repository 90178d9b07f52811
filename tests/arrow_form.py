"""Masking as an Arrow-batched pandas UDF: a second physical form with the same result.

Only the text column goes to Python. The built-in form in ``operators.mask`` is the faster one, on
plain documents and on texts packed with values alike; this one is an independent check of it.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskwright.functions import rows
from maskwright.functions.arrays import evaluated_once
from maskwright.functions.catalogue import CATEGORIES
from maskwright.functions.checksums import INN_10, INN_12_FIRST, INN_12_SECOND
from maskwright.functions.spans import SPAN_TYPE

RESULT = f"struct<masked_text:string,spans:array<{SPAN_TYPE}>>"


def _batch_masker() -> Callable[[pd.Series], pd.DataFrame]:
    """A function of one Arrow batch. It closes over plain data only, so that executors need
    nothing but pandas. The catalogue's expressions mean the same to Python's ``re``."""
    shapes = [(c.name, c.regex) for c in CATEGORIES]
    weights = {10: (INN_10,), 12: (INN_12_FIRST, INN_12_SECOND)}

    def mask_batch(texts: pd.Series) -> pd.DataFrame:
        import re

        import numpy as np
        import pandas as pd

        def passes(name: str, raw: str) -> bool:
            digits = [int(c) for c in raw if c.isdigit()]
            if name == "INN":
                return all(
                    np.dot(w, digits[: len(w)]) % 11 % 10 == digits[len(w)]
                    for w in weights[len(digits)]
                )
            if name == "CARD":
                twice = np.array(digits[-2::-2]) * 2
                return (sum(digits[-1::-2]) + (twice // 10 + twice % 10).sum()) % 10 == 0
            return True

        texts = texts.fillna("").reset_index(drop=True)
        found = [
            (row, m.start(), order, name, m.group(), m.end())
            for order, (name, regex) in enumerate(shapes)
            for pattern in [re.compile(regex)]
            for row, text in texts.items()
            for m in pattern.finditer(text)
            if passes(name, m.group())
        ]
        columns = ["row", "start", "ord", "category", "original", "end"]
        hits = pd.DataFrame(found, columns=columns).sort_values(["row", "start", "ord"])
        # Each row's texts are laid end to end, so that one sweep serves the whole batch.
        offset = hits["row"].to_numpy(dtype=np.int64) << 32
        reach, kept = -1, np.zeros(len(hits), dtype=bool)
        for i, (start, end) in enumerate(zip(offset + hits["start"], offset + hits["end"])):
            if start >= reach:
                kept[i], reach = True, end
        hits = hits[kept]
        number = hits.groupby(["row", "ord"]).cumcount() + 1
        hits = hits.assign(
            placeholder=[f"<{c}_{n:03d}>" for c, n in zip(hits["category"], number)]
        )
        masked, spans = list(texts), [[] for _ in texts]
        fields = ["start", "end", "category", "placeholder", "original"]
        for row, mine in hits.groupby("row"):
            records = mine[fields].to_dict("records")
            text, at, out = masked[row], 0, []
            for r in records:
                out += [text[at : r["start"]], r["placeholder"]]
                at = r["end"]
            masked[row], spans[row] = "".join(out) + text[at:], records
        return pd.DataFrame({"masked_text": masked, "spans": spans})

    return mask_batch


def masked_by_arrow(text: Column) -> Column:
    """Struct of masked text and numbered spans of a text column."""
    return F.pandas_udf(_batch_masker(), RESULT)(text)


def mask_arrow(
    df: DataFrame,
    text: str | Column = "text",
    output_field: str = "masked",
    entities_field: str | None = None,
    on_error: str = "fail",
) -> DataFrame:
    """Add masked text and, if asked for, the spans that hold the original values."""
    out = df.withColumn("__mw_text", rows.as_column(text))
    out = evaluated_once(
        out.withColumn("__mw_py", masked_by_arrow(F.col("__mw_text"))),
        {"__mw_masked": F.col("__mw_py.masked_text"), "__mw_spans": F.col("__mw_py.spans")},
    )
    output = F.struct(
        F.col("__mw_masked").alias("masked_text"), F.lit(rows.SOURCE).alias("source")
    )
    problems = [(~rows.is_filled(F.col("__mw_text")), rows.MASK_TEXT_EMPTY)]
    out = rows.emit(out, output_field, output, problems, on_error)
    if entities_field:
        out = out.withColumn(entities_field, F.col("__mw_spans"))
    return out.drop(*[c for c in out.columns if c.startswith("__mw_")])
