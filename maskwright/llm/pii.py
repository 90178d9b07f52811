"""Personal data by fixed patterns, and by contexts learned from what these find.

Four kinds are matched by fixed patterns, in built-in expressions alone. Their matches seed a
bootstrap. A fixed match is an instance, whole; elsewhere a token that holds a digit or an at sign is
one, and so is a run of number tokens with nothing but blanks, brackets, dots and dashes between them.
The one or two words before the whole instance, numbers too, are lexical patterns. Patterns and instances form a graph, each edge weighed once. In each of
``rounds`` a pattern's score for a kind becomes the share of its instances' scores, and an
instance's score the best of its patterns'; seeds keep theirs. Patterns with a score of ``accept``
and ``seeds`` seeds at least then mark the instances that they stand before, where no fixed match
lies.

A text is scanned once: matches and instances are written without it, and all that follows works on
those. The graph is summed before it is shuffled, its edges are distinct, and no pattern or instance
is gathered in one row, so a word that stands before a third of all instances is one sum for each
task, and a join that adaptive execution splits.

Patterns are written for the matcher: classes are possessive, runs begin only where no run goes on,
and separators between digits are exchanged for one sign, so that no pattern repeats a group over
the digits of a card.

Defined results: a null text is empty and has no spans. Rows that repeat an id and a text get the
same row each; a null id is kept as null. Spans count code points, ends are exclusive. An empty
table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskwright.functions.arrays import bind, evaluated_once, running
from maskwright.sources.staging import stage

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
ACCEPT = 0.8
SEEDS = 3
LEAST_DIGITS = 4

# Signs of the private use area; texts that hold them take a way without.
MARK = ""
JOIN = ""

SPAN = "struct<start:int,stop:int,raw:string>"
LOCAL = "A-Za-z0-9._%+-"
LABEL = "A-Za-z0-9-"

# As the contract has them, for the matcher: same matches, no group over a run of digits.
EMAIL = rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[{LABEL}]++(?:\.[{LABEL}]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = rf"(?<![0-9{JOIN}])[0-9][0-9{JOIN}]{{12,}}+"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
# The way to a blank that stands between number tokens, from a token's start or the blank before.
NUMBER = "[0-9][0-9().+-]*+"
RUN = (
    rf"((?:\G(?!\A)[0-9().+-]*+|(?<!\S)[^\s0-9@]*+(?<![\p{{L}}_]){NUMBER})) "
    rf"(?=[ ().+-]*+{NUMBER}[,;:!?\]>\"']*+(?!\S))"
)
TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"


def matches(text: Column, pattern: str) -> Column:
    """Leftmost matches with their places, and the text before each since the last as ``gap``."""
    marked = F.regexp_replace(text, F.lit(pattern), F.lit(MARK))
    gaps = F.when(F.contains(text, F.lit(MARK)), F.split(text, pattern, -1)).otherwise(
        F.split(marked, MARK, -1)
    )
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(both: Column) -> Column:
        items = F.transform(
            both["found"], lambda m, i: F.struct(m.alias("raw"), F.get(both["gaps"], i).alias("gap"))
        )
        return running(
            items,
            F.lit(0),
            lambda at, x: at + F.length(x["gap"]) + F.length(x["raw"]),
            lambda at, x: F.struct(
                (at + F.length(x["gap"])).alias("start"),
                (at + F.length(x["gap"]) + F.length(x["raw"])).alias("stop"),
                x["raw"].alias("raw"),
                x["gap"].alias("gap"),
            ),
            "struct<start:int,stop:int,raw:string,gap:string>",
        )

    return bind(F.struct(found.alias("found"), gaps.alias("gaps")), placed)


def where_valid(found: Column, valid) -> Column:
    return F.transform(
        F.filter(found, lambda m: valid(m["raw"])),
        lambda m: F.struct(m["start"], m["stop"], m["raw"]),
    )


def is_ip(raw: Column) -> Column:
    def small(part: Column) -> Column:
        digits = F.ltrim(part, F.lit("0"))
        return (F.length(digits) < 3) | ((F.length(digits) == 3) & (digits <= "255"))

    return F.forall(F.split(raw, r"\."), small)


def is_card(raw: Column) -> Column:
    digits = F.translate(raw, JOIN, "")
    return F.length(digits).between(13, 19) & F.call_function("luhn_check", digits)


def is_phone(raw: Column) -> Column:
    return F.length(F.regexp_replace(raw, "[^0-9]", "")).between(9, 15)


def base_spans(text: Column) -> dict[str, Column]:
    """The matches of each kind. A kind is searched where its signs stand in the text."""
    none = F.array().cast(f"array<{SPAN}>")
    joined = F.regexp_replace(F.translate(text, JOIN, "x"), "(?<=[0-9])[ -](?=[0-9])", JOIN)
    found = {
        "email": (F.contains(text, F.lit("@")), lambda: where_valid(matches(text, EMAIL), lambda r: F.lit(True))),
        "ip": (F.rlike(text, F.lit(r"[0-9]\.[0-9]")), lambda: where_valid(matches(text, IP), is_ip)),
        "card": (
            F.rlike(text, F.lit("[0-9][ -]?[0-9]")),
            lambda: bind(joined, lambda j: where_valid(matches(j, CARD), is_card)),
        ),
        "phone": (F.contains(text, F.lit("+")), lambda: where_valid(matches(text, PHONE), is_phone)),
    }
    return {kind: F.when(gate, spans()).otherwise(none) for kind, (gate, spans) in found.items()}


def last_words(text: Column) -> Column:
    """The last two words, joined by a blank."""
    words = F.split(F.trim(F.regexp_replace(text, r"\s+", F.lit(" "))), " ")
    return bind(words, lambda w: F.concat_ws(" ", F.get(w, F.size(w) - 2), F.element_at(w, -1)))


def instances(text: Column) -> Column:
    """Tokens with a digit or an at sign, and runs of number tokens, without the signs around them,
    and the two words before."""

    def one(words: Column, m: Column) -> Column:
        raw = F.translate(m["raw"], JOIN, " ")
        front = F.length(raw) - F.length(F.regexp_replace(raw, "^[\"'(\\[<]+", ""))
        inner = F.regexp_replace(F.substr(raw, front + 1), "[.,;:!?)\\]>\"']+$", "")
        return F.struct(
            (m["start"] + front).alias("start"),
            (m["start"] + front + F.length(inner)).alias("stop"),
            F.lower(inner).alias("raw"),
            F.lower(last_words(F.concat(words, m["gap"]))).alias("words"),
        )

    kind = "struct<start:int,stop:int,raw:string,words:string>"
    joined = F.regexp_replace(F.translate(text, JOIN, "x"), F.lit(RUN), F.lit(f"$1{JOIN}"))
    placed = running(
        bind(joined, lambda j: matches(j, TOKEN)),
        F.lit(""),
        lambda words, m: last_words(F.concat(words, m["gap"], F.translate(m["raw"], JOIN, " "))),
        one,
        kind,
    )
    return F.when(F.rlike(text, F.lit("[0-9@]")), placed).otherwise(F.array().cast(f"array<{kind}>"))


def patterns_of(words: Column) -> Column:
    """The last word, and the last two."""
    both = F.substring_index(words, " ", -2)
    return F.filter(
        F.array(
            F.when(words != "", F.concat(F.lit("1 "), F.substring_index(words, " ", -1))),
            F.when(F.contains(words, F.lit(" ")), F.concat(F.lit("2 "), both)),
        ),
        lambda p: p.isNotNull(),
    )


def meets(a: Column, b: Column) -> Column:
    return (a["start"] < b["stop"]) & (b["start"] < a["stop"])


def scanned(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Ids, a hash of the text, matches of each kind and instances; the text itself is left."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("body")
    )
    body = F.col("body")
    rows = evaluated_once(rows, {**base_spans(body), "found": instances(body)})
    return rows.select("doc_id", F.xxhash64("body").alias("h"), *KINDS, "found")


def occurrences(rows: DataFrame) -> DataFrame:
    """One row per instance in a text: fixed matches, with their kind, and tokens that meet none."""

    def numbered(kind: int) -> Column:
        return F.transform(
            KINDS[kind], lambda s: F.struct(F.lit(kind).alias("seed"), s["start"], s["stop"], s["raw"])
        )

    fixed = reduce(F.concat, map(numbered, range(len(KINDS)))).cast(
        "array<struct<seed:int,start:int,stop:int,raw:string>>"
    )
    one = rows.select("doc_id", "h", fixed.alias("fixed"), F.explode("found").alias("x"))
    one = one.withColumn("fixed", F.filter("fixed", lambda s: meets(s, F.col("x"))))
    # Each match stands with the token that it begins in; the first kind goes before the others.
    begun = F.filter(
        "fixed",
        lambda s: (s["start"] >= F.col("x.start"))
        & ~F.exists("fixed", lambda o: (o["seed"] < s["seed"]) & meets(o, s)),
    )

    def matched(s: Column) -> Column:
        front = F.regexp_replace(F.substr(F.col("x.raw"), F.lit(1), s["start"] - F.col("x.start")), "[\"'(\\[<]+$", "")
        return F.struct(
            s["start"].alias("start"), s["stop"].alias("stop"),
            F.lower(F.translate(s["raw"], JOIN, " ")).alias("raw"),
            last_words(F.concat_ws(" ", F.col("x.words"), front)).alias("words"), s["seed"].alias("seed"),
        )

    itself = F.struct("x.start", "x.stop", "x.raw", "x.words", F.lit(None).cast("int").alias("seed"))
    kind = "array<struct<start:int,stop:int,raw:string,words:string,seed:int>>"
    items = F.when(F.size("fixed") > 0, F.transform(begun, matched).cast(kind)).otherwise(F.array(itself).cast(kind))
    return one.select("doc_id", "h", F.inline(items)).select(
        "doc_id", "h", "start", "stop", "raw", patterns_of(F.col("words")).alias("patterns"), "seed"
    )


def scored_patterns(edges: DataFrame, rounds: int) -> DataFrame:
    """Patterns with a score and a number of seeds for each kind.

    ``edges`` are distinct: ``pattern, raw, seed``, with ``raw`` of one seed at most.
    """
    seeds = [F.when(F.col("seed") == i, 1.0).otherwise(0.0).alias(f"s{i}") for i in range(len(KINDS))]
    now = edges.select("pattern", "raw", "seed", *seeds)
    for k in range(rounds):
        patterns = now.groupBy("pattern").agg(
            *[(F.sum(f"s{i}") / (F.count(F.lit(1)) + 1)).alias(f"p{i}") for i in range(len(KINDS))],
            *[F.count(F.when(F.col("seed") == i, 1)).alias(f"n{i}") for i in range(len(KINDS))],
        )
        if k + 1 == rounds:
            return patterns
        best = (
            now.select("pattern", "raw", "seed").join(patterns, "pattern").where("seed is null")
            .groupBy("raw").agg(*[F.max(f"p{i}").alias(f"b{i}") for i in range(len(KINDS))])
        )
        now = stage(
            now.select("pattern", "raw", "seed", *[f"s{i}" for i in range(len(KINDS))])
            .join(best, "raw", "left")
            .select("pattern", "raw", "seed", *[F.coalesce(f"b{i}", f"s{i}").alias(f"s{i}") for i in range(len(KINDS))]),
            "pattern-scores",
        )
    raise ValueError("rounds must be positive")


def discovered(rows: DataFrame, rounds: int, accept: float, seeds: int, least_digits: int) -> DataFrame:
    """Instances that accepted patterns stand before: ``doc_id, h, start, stop, kind``."""
    found = stage(occurrences(rows), "instances")
    # An instance that is a seed anywhere is one everywhere, of its first kind.
    edges = stage(
        found.select(F.explode("patterns").alias("pattern"), "raw", "seed")
        .groupBy("pattern", "raw").agg(F.min("seed").alias("seed")),
        "pattern-edges",
    )
    known = edges.groupBy("raw").agg(F.min("seed").alias("own"))
    edges = edges.drop("seed").join(known, "raw").withColumnRenamed("own", "seed")
    patterns = scored_patterns(edges, rounds)
    best = F.greatest(*[F.struct(F.col(f"p{i}").alias("p"), F.lit(i).alias("kind"), F.col(f"n{i}").alias("n")) for i in range(len(KINDS))])
    accepted = patterns.select("pattern", best.alias("best")).where((F.col("best.p") >= accept) & (F.col("best.n") >= seeds))
    digits = F.length(F.regexp_replace("raw", "[^0-9]", ""))
    unseen = found.where(F.col("seed").isNull() & (F.col("stop") > F.col("start"))).where(
        (digits >= least_digits) | F.contains("raw", F.lit("@"))
    )
    return (
        unseen.select("doc_id", "h", "start", "stop", F.explode("patterns").alias("pattern"))
        .join(accepted, "pattern")
        .groupBy("doc_id", "h", "start", "stop")
        .agg(F.max(F.struct("best.p", "best.kind")).alias("best"))
        .select("doc_id", "h", "start", "stop", F.col("best.kind").alias("kind"))
    )


def of_kind(spans: Column, kind: int) -> Column:
    """Spans with their kind's number in front, by which they are sorted."""
    return F.transform(
        spans, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"))
    )


def written(spans: Column) -> Column:
    """``kind:start:end`` of spans, comma-joined."""
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1), s["start"], s["stop"])
        ),
        ",",
    )


def find_personal_data(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rounds: int = ROUNDS,
    accept: float = ACCEPT,
    seeds: int = SEEDS,
    least_digits: int = LEAST_DIGITS,
) -> DataFrame:
    """One row per document: counts and spans of the fixed matches, and all spans."""
    rows = stage(scanned(docs, id_col, text_col), "personal-data")
    more = discovered(rows, rounds, accept, seeds, least_digits).groupBy("doc_id", "h").agg(
        F.collect_set(F.struct("kind", "start", "stop")).alias("more")
    )
    more = more.withColumnsRenamed({"doc_id": "other_id", "h": "other_h"})
    same = F.col("doc_id").eqNullSafe(F.col("other_id")) & (F.col("h") == F.col("other_h"))
    base = reduce(F.concat, [of_kind(F.col(k), i) for i, k in enumerate(KINDS)])
    none = F.array().cast("array<struct<kind:int,start:int,stop:int>>")
    return (
        rows.drop("found")
        .join(more, same, "left")
        .select(
            "doc_id",
            *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
            F.sha2(written(base), 256).alias("base_sha256"),
            written(F.array_sort(F.concat(base, F.coalesce("more", none)))).alias("spans"),
        )
    )
