"""From match arrays to numbered spans and masked text, all inside one row.

Positions are 0-based, half open, and count characters (code points), as Spark's own string
functions do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskwright.functions.arrays import BLOCK, bind, evaluated_once, running
from maskwright.functions.catalogue import PLACES, Category, wanted

HIT_TYPE = "struct<start:int,ord:int,category:string,raw:string,end:int>"
SPAN_TYPE = "struct<start:int,end:int,category:string,placeholder:string,original:string>"

TEXT = "__mw_text"

_MARK = "\uE000"

# Up to this many matches of a category are looked for one by one.
LOCATED = 8


def match_column(category: Category) -> str:
    return f"__mw_{category.name.lower()}"


def with_matches(df: DataFrame, text: Column, categories=None) -> DataFrame:
    """Add the text and one array of raw matches per wanted category, as working columns.

    A category's expression runs only where its place in the catalogue leaves something to
    search, so a row without personal data costs two byte searches and two passes, not eight.
    """
    cats = wanted(categories)
    body = F.col(TEXT)
    out = df.withColumn(TEXT, text)
    if not cats:
        return out
    parts = {c.place: PLACES[c.place](body) for c in cats}
    held = {place: f"__mw_in_{place}" for place in parts}
    out = out.withColumns({held[place]: part for place, part in parts.items()})
    none = F.array().cast("array<string>")
    found = {
        match_column(c): F.coalesce(c.matches(F.col(held[c.place])), none) for c in cats
    }
    return evaluated_once(out, found).drop(*held.values())


def _gaps(text: Column, category: Category) -> Column:
    """The text before, between and after a category's matches.

    ``split`` compiles its expression for every row, ``regexp_replace`` once per task. So the
    matches become a mark first, and the text is split at the mark, which is a plain character.
    A text that holds the mark itself takes the direct way.
    """
    marked = F.regexp_replace(text, F.lit(category.regex), F.lit(_MARK))
    return F.when(
        F.contains(text, F.lit(_MARK)), F.split(text, category.regex, -1)
    ).otherwise(F.split(marked, _MARK, -1))


def _placed(search: Column) -> Column:
    """Hits of one category with their positions.

    Spark reports matches but not where they are: the running sum of the lengths of gaps and
    matches is the position of each match.
    """
    pieces = F.transform(
        search["matches"],
        lambda m, i: F.struct(
            F.length(F.get(search["gaps"], i)).alias("gap"),
            F.length(m).alias("size"),
            m.alias("raw"),
        ),
    )
    return running(
        pieces,
        F.lit(0),
        lambda at, p: at + p["gap"] + p["size"],
        lambda at, p: F.struct(
            (at + p["gap"]).alias("start"),
            search["ord"].alias("ord"),
            search["category"].alias("category"),
            p["raw"].alias("raw"),
            (at + p["gap"] + p["size"]).alias("end"),
        ),
        HIT_TYPE,
    )


def _located(text: Column, category: Category, matches: Column) -> Column:
    """Valid hits of one category, by looking for each match as a plain string in the text."""
    return F.transform(
        category.keep_valid(matches),
        lambda m: F.struct(
            (F.position(m, text) - 1).alias("start"),
            F.lit(category.order).alias("ord"),
            F.lit(category.name).alias("category"),
            m.alias("raw"),
            (F.position(m, text) - 1 + F.length(m)).alias("end"),
        ).cast(HIT_TYPE),
    )


def hits_in_order(text: Column, categories=None) -> Column:
    """Valid hits of all categories by start; those that start together keep catalogue order.

    A match that the text holds once stands there, which costs less to find than a second pass of the
    expression. That reads the text for each match, so it is done where there are few.
    """
    cats = wanted(categories)
    empty = F.array().cast(f"array<{HIT_TYPE}>")
    if not cats:
        return empty

    def search(category: Category) -> Column:
        matches = F.col(match_column(category))
        any_valid = (
            F.size(matches) > 0 if category.check is None else F.exists(matches, category.check)
        )
        # Broken UTF-8 is mended in a match, which is then not found.
        unclear = F.exists(
            matches,
            lambda m: (F.position(m, text) == 0) | (F.position(m, text, F.position(m, text) + 1) > 0),
        )
        several = (F.size(matches) > LOCATED) | unclear
        gaps = F.struct(
            F.lit(category.order).alias("ord"),
            F.lit(category.name).alias("category"),
            matches.alias("matches"),
            _gaps(text, category).alias("gaps"),
        )
        placed = bind(gaps, _placed)
        if category.check is not None:
            placed = F.filter(placed, lambda h: category.check(h["raw"]))
        return F.when(
            any_valid, F.when(several, placed).otherwise(_located(text, category, matches))
        ).otherwise(empty)

    found = F.flatten(F.array(*[search(c) for c in cats]))
    any_match = sum((F.size(match_column(c)) for c in cats), F.lit(0)) > 0
    return F.when(any_match, F.sort_array(found)).otherwise(empty)


def without_overlaps(hits: Column) -> Column:
    """Keep each hit that starts at or after the end of the last hit kept.

    A refused hit does not move the end. Rows where no neighbours touch skip the sweep.
    """
    clash = F.exists(
        F.transform(
            hits,
            lambda h, i: F.coalesce(h["start"] < F.get(hits, i - 1)["end"], F.lit(False)),
        ),
        lambda c: c,
    )
    swept = F.filter(
        running(
            hits,
            F.lit(0),
            lambda end, h: F.when(h["start"] >= end, h["end"]).otherwise(end),
            lambda end, h: F.when(h["start"] >= end, h),
            HIT_TYPE,
        ),
        lambda h: h.isNotNull(),
    )
    return F.when(clash, swept).otherwise(hits)


def numbered(accepted: Column) -> Column:
    """Give each hit its placeholder, counting from 1 within its category."""

    def of(order: Column) -> Column:
        return F.transform(
            F.filter(accepted, lambda h: h["ord"] == order),
            lambda h, i: F.struct(
                h["start"].alias("start"),
                h["end"].alias("end"),
                h["category"].alias("category"),
                F.format_string("<%s_%03d>", h["category"], i + 1).alias("placeholder"),
                h["raw"].alias("original"),
            ),
        )

    present = F.array_distinct(F.transform(accepted, lambda h: h["ord"]))
    return F.array_sort(F.flatten(F.transform(present, of)))


def spans(hits: Column) -> Column:
    """Ordered hits to non-overlapping, numbered spans."""
    empty = F.array().cast(f"array<{SPAN_TYPE}>")
    return bind(
        hits,
        lambda h: F.when(F.size(h) > 0, bind(without_overlaps(h), numbered)).otherwise(empty),
    )


def _end_before(spans_: Column, index: Column) -> Column:
    """End of the span before ``index``, or 0."""
    return F.coalesce(F.get(spans_, index - 1)["end"], F.lit(0))


def splice(text: Column, spans_: Column) -> Column:
    """Text with each span replaced by its placeholder.

    ``substring`` walks a string from its first byte, so the text is first cut into one slice
    per block of spans and the pieces are cut from the slice.
    """

    def block(first: Column) -> Column:
        part = F.slice(spans_, first + 1, F.lit(BLOCK))
        base = _end_before(spans_, first)
        stop = F.element_at(part, -1)["end"]

        def pieces(body: Column) -> Column:
            return F.transform(
                part,
                lambda s, i: F.concat(
                    F.substring(
                        body,
                        _end_before(spans_, first + i) - base + 1,
                        s["start"] - _end_before(spans_, first + i),
                    ),
                    s["placeholder"],
                ),
            )

        return F.array_join(bind(F.substring(text, base + 1, stop - base), pieces), "")

    starts = F.sequence(F.lit(0), F.size(spans_) - 1, F.lit(BLOCK))
    tail = F.substring(text, F.element_at(spans_, -1)["end"] + 1, F.length(text))
    return F.when(
        F.size(spans_) > 0,
        F.concat(F.array_join(F.transform(starts, block), ""), tail),
    ).otherwise(text)


def entities(spans_: Column) -> Column:
    """Spans as entity records: what was found, what stands for it, and where it was."""
    return F.transform(
        spans_,
        lambda s: F.struct(
            s["category"].alias("category"),
            s["placeholder"].alias("placeholder"),
            s["original"].alias("original"),
            s["start"].alias("start"),
            s["end"].alias("end"),
        ),
    )
