"""Putting original values back, and finding placeholders that nobody issued."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from maskwright.functions.arrays import bind, looked_up
from maskwright.functions.catalogue import PLACEHOLDER_RE, PREEXISTING_RE

_MARK = "\uE000"
PAIR_TYPE = "struct<placeholder:string,original:string>"


def _pair(placeholder: Column, original: Column) -> Column:
    return F.struct(placeholder.alias("placeholder"), original.alias("original"))


def _usable(pairs: Column) -> Column:
    """Drop pairs that cannot be applied: a missing side, or an empty placeholder."""
    return F.filter(
        pairs, lambda e: (e["placeholder"] != "") & e["original"].isNotNull()
    )


def no_pairs() -> Column:
    return F.array().cast(f"array<{PAIR_TYPE}>")


def pairs_from_array(entities: Column) -> Column:
    """Placeholder and original of each entity record; a null list is an empty one."""
    listed = F.transform(entities, lambda e: _pair(e["placeholder"], e["original"]))
    return F.coalesce(_usable(listed), no_pairs())


def pairs_from_json(entities: Column) -> Column:
    """The same from a JSON array.

    Null, broken JSON and anything but an array count as an empty list. Elements whose
    placeholder or original is not a JSON string are dropped, numbers included. Of a key that an
    object repeats the last one counts.
    """
    return F.coalesce(_usable(listed_json(entities)), no_pairs())


def _text_of(value: Column) -> Column:
    """A variant's text, if it is one."""
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))


def listed_json(entities: Column) -> Column:
    """A pair for each element of a JSON array, with nulls where it has no text; null for no array."""

    def field(element: Column, name: str) -> Column:
        return _text_of(F.try_variant_get(element, f"$.{name}", "variant"))

    parsed = F.try_variant_get(F.try_parse_json(entities), "$", "array<variant>")
    plain = F.transform(parsed, lambda e: _pair(field(e, "placeholder"), field(e, "original")))

    # Unless the session allows it (see plans.session), a variant cannot hold an object that repeats a
    # key. Objects are then read one by one from their text, by a reader that takes the last value of a
    # key, if it does not repeat keys within that value; loose strings become null first, so that none
    # can pass for an object.
    texts = F.from_json(_without_loose_strings(entities), "array<string>")
    repeated = F.transform(
        texts,
        lambda e: bind(
            F.from_json(F.when(F.startswith(e, F.lit("{")), e), "placeholder variant, original variant"),
            lambda o: _pair(_text_of(o["placeholder"]), _text_of(o["original"])),
        ),
    )
    # In another pair of brackets a whole list is one element; a broken one, or one with more behind
    # it, is not.
    whole = F.json_array_length(F.concat(F.lit("["), entities, F.lit("]"))) == 1
    is_list = whole & F.json_array_length(entities).isNotNull()
    return F.when(is_list, F.coalesce(plain, repeated))


def _without_loose_strings(json: Column) -> Column:
    """JSON text in which strings that are neither a key nor the value of one are null."""
    text = r'"(?:[^"\\]|\\.)*+"'
    member = rf"({text}\s*+:\s*+(?:{text})?+)"
    marked = F.regexp_replace(json, rf"{member}|{text}", f"$1{_MARK}")
    # What was kept is followed by a mark, what was not is a mark alone.
    kept = F.regexp_replace(marked, rf"{member}{_MARK}", "$1")
    return F.when(F.contains(json, F.lit(_MARK)), json).otherwise(
        F.regexp_replace(kept, _MARK, "null")
    )


def dropped_elements(entities: Column) -> Column:
    """How many elements of a JSON array cannot be used."""
    listed = listed_json(entities)
    return F.coalesce(F.size(listed) - F.size(_usable(listed)), F.lit(0))


# Up to this many pairs are replaced one after the other; both ways give the same text.
FEW = 16

_SHAPE = PREEXISTING_RE
# The beginning of a placeholder that is not finished, at the end or before another placeholder.
_OPEN = r"<[A-Z]*+(?:_[0-9]*+)?"
_OPEN_END = rf"{_OPEN}\z"
_OPEN_BEFORE = rf"{_OPEN}(?={_SHAPE})"
_PIECE = "struct<fresh:boolean,origin:int,text:string>"


def _in_turn(text: Column, pairs: Column) -> Column:
    return F.aggregate(
        pairs, text, lambda out, e: F.replace(out, e["placeholder"], e["original"])
    )


def _cut(text: Column) -> Column:
    """Array of (gap, placeholder after it or null): what a text consists of."""
    marked = F.regexp_replace(text, F.lit(_SHAPE), F.lit(_MARK))
    gaps = F.when(F.contains(text, F.lit(_MARK)), F.split(text, _SHAPE, -1)).otherwise(
        F.split(marked, _MARK, -1)
    )

    def paired(tokens: Column) -> Column:
        return F.transform(
            gaps, lambda g, i: F.struct(g.alias("gap"), F.get(tokens, i).alias("token"))
        )

    return bind(F.regexp_extract_all(text, F.lit(_SHAPE), 0), paired)


def _piece(fresh: Column, origin: Column, text: Column) -> Column:
    return F.struct(fresh.alias("fresh"), origin.alias("origin"), text.alias("text")).cast(_PIECE)


def _holds_placeholder(text: Column) -> Column:
    return F.rlike(text, F.lit(_SHAPE))


def _one_round(pieces: Column, pairs: Column) -> Column:
    """Cut each fresh piece at its placeholders, and put the originals between as fresh pieces.

    A piece comes from the text (-1) or from the original of a pair, and only later pairs apply
    to it.
    """
    no = F.lit(False)

    def cut(p: Column) -> Column:
        done = F.array(F.struct(p["text"].alias("gap"), F.lit(None).cast("string").alias("token")))
        return F.transform(
            F.when(p["fresh"], _cut(p["text"])).otherwise(done),
            lambda c: F.struct(
                c["gap"].alias("gap"), c["token"].alias("token"), p["origin"].alias("origin")
            ),
        )

    def rebuilt(items: Column) -> Column:
        found = looked_up(
            items, "token", "origin", pairs, "placeholder", "original", "string", "string"
        )

        def put(answers: Column) -> Column:
            def both(c: Column, i: Column) -> Column:
                answer = F.get(answers, i)
                original = answer["value"]
                back = _piece(_holds_placeholder(original), answer["at"], original)
                kept = _piece(no, c["origin"], F.coalesce(c["token"], F.lit("")))
                return F.array(
                    _piece(no, c["origin"], c["gap"]),
                    F.when(answer["at"].isNotNull(), back).otherwise(kept),
                )

            return F.filter(F.flatten(F.transform(items, both)), lambda p: p["text"] != "")

        return bind(found, put)

    return bind(F.flatten(F.transform(pieces, cut)), rebuilt)


def _at_once(text: Column, pairs: Column) -> Column:
    """The same as one after the other, for texts and pairs that are :func:`_regular`."""
    nested = F.size(F.filter(pairs, lambda e: _holds_placeholder(e["original"])))
    start = F.array(_piece(F.lit(True), F.lit(-1), text))

    def step(pieces: Column, _: Column) -> Column:
        fresh = F.exists(pieces, lambda p: p["fresh"])
        return F.when(fresh, _one_round(pieces, pairs)).otherwise(pieces)

    rounds = F.sequence(F.lit(0), nested)
    whole = F.aggregate(rounds, start, step)
    return F.array_join(F.transform(whole, lambda p: p["text"]), "")


def _regular(text: Column, pairs: Column) -> Column:
    """All placeholders have their shape, and none can grow together where pieces meet."""
    odd = F.exists(
        pairs,
        lambda e: ~F.rlike(e["placeholder"], F.lit(rf"\A{_SHAPE}\z"))
        | F.rlike(e["original"], F.lit(_OPEN_END))
        | F.rlike(e["original"], F.lit(_OPEN_BEFORE)),
    )
    return ~odd & ~F.rlike(text, F.lit(_OPEN_BEFORE))


def restore_text(text: Column, pairs: Column) -> Column:
    """Replace every occurrence of each placeholder, in list order.

    One after the other: an original that contains a later placeholder is itself rewritten.

    For long lists that would read the text once per pair. Placeholders cannot overlap, so the
    text is cut at all of them at once, each is looked up, and only the originals that hold
    placeholders themselves are cut again, with the pairs behind theirs. Lists with placeholders
    of other shapes, and texts in which a placeholder could form where two pieces meet, are
    replaced pair by pair.
    """

    def by(listed: Column) -> Column:
        several = (F.size(listed) > FEW) & _regular(text, listed)
        return F.when(several, _at_once(text, listed)).otherwise(_in_turn(text, listed))

    return bind(pairs, by)


def hallucinated(restored: Column, pairs: Column) -> Column:
    """Three-digit placeholders still in the text that the list does not know, each once."""
    left = F.regexp_extract_all(restored, F.lit(PLACEHOLDER_RE), 0)
    known = F.transform(pairs, lambda e: e["placeholder"])
    return F.when(F.size(left) > 0, F.array_except(left, known)).otherwise(left)


def preexisting_placeholder(text: Column) -> Column:
    """True where unmasked text already holds a placeholder and so would not round-trip."""
    return F.coalesce(F.rlike(text, F.lit(PREEXISTING_RE)), F.lit(False))
