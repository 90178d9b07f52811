"""The same functions for SQL users: temporary SQL functions and views, no Python at run time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from maskwright.functions.catalogue import (
    CATEGORIES,
    CHAIN,
    CHAIN_BREAK,
    DOTTED,
    PLACEHOLDER_RE,
    PREEXISTING_RE,
    Category,
)
from maskwright.functions.checksums import (
    CARD_DIGITS,
    INN_10,
    INN_12_FIRST,
    INN_12_SECOND,
)


def literal(text: str) -> str:
    """A SQL string literal, whatever the text holds."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _check(digits: str, weights: tuple[int, ...]) -> str:
    def digit(i: int) -> str:
        return f"try_cast(substr({digits}, {i}, 1) AS int)"

    total = " + ".join(f"{digit(i)} * {w}" for i, w in enumerate(weights, start=1))
    return f"(({total}) % 11 % 10 = {digit(len(weights) + 1)})"


def _bound(value: str, name: str, body: str) -> str:
    """``body`` with a name for a value that is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _digits_of(value: str) -> str:
    return f"regexp_replace({value}, '[^0-9]', '')"


def _inn(d: str) -> str:
    return (
        f"coalesce(CASE length({d}) WHEN 10 THEN {_check(d, INN_10)} WHEN 12 THEN "
        f"{_check(d, INN_12_FIRST)} AND {_check(d, INN_12_SECOND)} END, false)"
    )


def _luhn(d: str) -> str:
    return f"coalesce(length({d}) BETWEEN {CARD_DIGITS[0]} AND {CARD_DIGITS[1]} AND luhn_check({d}), false)"


# Matches of numbers hold digits, blanks and dashes only.
_CHECKS = {"INN": lambda m: _inn(m), "CARD": lambda m: _bound(f"translate({m}, ' -', '')", "d", _luhn("d"))}
_NONE = "cast(array() AS array<string>)"


def _part(place: str) -> str:
    """The part of a text that a category is looked for in; null where it cannot be."""
    if place == "chains":
        # Nothing matches in an empty text; nullif would join the chains twice.
        return f"array_join(regexp_extract_all(text, {literal(CHAIN)}, 0), '{CHAIN_BREAK}')"
    test = {
        "around_at": "contains(text, '@')",
        "scheme": "contains(text, '://')",
        "dotted": f"text RLIKE {literal(DOTTED)}",
    }[place]
    return f"CASE WHEN {test} THEN text END"


def _valid(category: Category, part: str) -> str:
    found = f"regexp_extract_all({part}, {literal(category.regex)}, 0)"
    return f"filter({found}, m -> {_CHECKS[category.name]('m')})" if category.name in _CHECKS else found


def _matches(category: Category) -> str:
    """Valid matches of a category in ``text``; null for no text."""
    found = _bound(_part(category.place), "p", _valid(category, "p"))
    return f"CASE WHEN text IS NOT NULL THEN coalesce({found}, {_NONE}) END"


def _all_matches() -> str:
    """The same of every category, as one array; each part of the text is made once."""
    places = dict.fromkeys(c.place for c in CATEGORIES)
    parts = "named_struct(" + ", ".join(f"'{place}', {_part(place)}" for place in places) + ")"
    found = ", ".join(
        f"named_struct('ord', {c.order}, 'category', '{c.name}', 'found', CASE WHEN text IS NOT NULL THEN "
        f"coalesce({_valid(c, f'p.{c.place}')}, {_NONE}) END)"
        for c in CATEGORIES
    )
    return _bound(parts, "p", f"array({found})")


_PAIRS = "array<struct<placeholder:string,original:string>>"


def definitions() -> dict[str, str]:
    """Signature and body of each function, by name."""
    out = {
        "inn_valid": f"(value string) RETURNS boolean RETURN {_bound(_digits_of('value'), 'd', _inn('d'))}",
        "luhn_valid": f"(value string) RETURNS boolean RETURN {_bound(_digits_of('value'), 'd', _luhn('d'))}",
    }
    for c in CATEGORIES:
        out[f"pii_{c.name.lower()}"] = f"(text string) RETURNS array<string> RETURN {_matches(c)}"
    record = "named_struct('ord', c.ord, 'category', c.category, 'nth', i + 1, 'raw', m)"
    listed = f"flatten(transform({_all_matches()}, c -> transform(c.found, (m, i) -> {record})))"
    out["pii_found"] = (
        f"(text string) RETURNS array<struct<ord:int,category:string,nth:int,raw:string>> RETURN {listed}"
    )
    # As a table, to be used laterally: FROM t, LATERAL pii_hits(t.text) h. Its body is a generator over
    # no table, which Spark applies to each row of t: no text is shuffled, compared or joined.
    out["pii_hits"] = (
        "(text string) RETURNS TABLE (ord int, category string, nth int, raw string) RETURN "
        f"SELECT inline({listed})"
    )
    out["pii_placeholders"] = (
        "(text string) RETURNS array<string> RETURN "
        f"array_distinct(regexp_extract_all(text, {literal(PLACEHOLDER_RE)}, 0))"
    )
    out["pii_has_placeholder"] = (
        "(text string) RETURNS boolean RETURN "
        f"coalesce(text RLIKE {literal(PREEXISTING_RE)}, false)"
    )
    out["pii_restore"] = (
        f"(text string, pairs {_PAIRS}) RETURNS string RETURN "
        "aggregate(filter(pairs, e -> e.placeholder <> '' AND e.original IS NOT NULL), text, "
        "(t, e) -> replace(t, e.placeholder, e.original))"
    )
    return out


def register_functions(spark: SparkSession) -> list[str]:
    """Create the functions in this session; Spark inlines them into each query's plan."""
    for name, body in definitions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    return list(definitions())


def register_views(
    df: DataFrame, prefix: str, text: str, key: list[str], workspace: str | None = None
) -> list[str]:
    """Create ``<prefix>_detected``, ``_masked``, ``_entities`` and ``_hits`` over a table."""
    from maskwright.operators.detect import detect, hits_long
    from maskwright.operators.mask import mask, mask_entities, without_text

    views = {
        "detected": detect(df, text, on_error="keep"),
        "masked": without_text(mask(df, text, key, workspace, on_error="keep"), text),
        "entities": mask_entities(df, text, key, workspace, on_error="skip"),
        "hits": without_text(hits_long(df, text, on_error="skip"), text),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(f"{prefix}_{name}")
    return [f"{prefix}_{name}" for name in views]
