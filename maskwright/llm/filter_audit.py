"""What each of five quality filters removes, for every order in which they can be applied.

A document's failures are a mask of five bits, and documents of one part with the same mask and the same
labels are alike, so the corpus is counted into cells once. Orders are listed by a recursive CTE: each
level extends the prefixes so far by one unused letter, joins the 32 mask cells, and carries the bits that
earlier steps have applied; a level emits, for each prefix and mask, whether the step keeps the mask's
documents, removes them, or finds them removed. That is 325 prefixes times 32 masks whatever the corpus
holds, so the list is broadcast to the cells. A prefix of ``k`` letters stands for all ``(5 - k)!`` orders
that begin with it: its figures are computed once and copied to them at the end.

Whether an equal text has a smaller id is found without moving texts: the least id of each digest is
counted, locally first, and the rows that hold it are found by id and digest together, so a text that very
many documents share has one row for each task and its documents stay spread.

Defined results: a null text is empty, a null part is the empty string. An empty text has no words, so it
fails A and, as 0 is not below 0, neither B nor C. Rows that repeat an id count each; none of them is a copy
of the others. A null id is never smaller than another and has no smaller one. A document with several
labels counts as good (toxic) if one says so; one without labels is neither. An empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The letters, their order, and what they ask for.
LETTERS = "ABCDE"
LEAST_WORDS = 50
DISTINCT_PERCENT = 65
UPPER_PERCENT = 5
SYMBOLS = "[#$%&*|]"
BLANKS = "\t\n\x0b\f\r"

COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")

# A prefix is a row for each mask. `applied` holds the bits of its letters but the last one, `bit` that one.
PREFIXES = """
WITH RECURSIVE steps(prefix, step, letter, bit, applied, mask) AS (
    SELECT letter, 1, letter, bit, 0, explode(sequence(0, {last})) FROM {letters}
    UNION ALL
    SELECT concat(s.prefix, l.letter), s.step + 1, l.letter, l.bit, s.applied | s.bit, s.mask
    FROM steps s JOIN {letters} l ON ((s.applied | s.bit) & l.bit) = 0
)
SELECT prefix, step, letter, mask,
       (mask & (applied | bit)) = 0 AS is_kept,
       (mask & applied) = 0 AND (mask & bit) <> 0 AS is_removed,
       (mask & applied) <> 0 AND (mask & bit) <> 0 AS is_redundant,
       mask = bit AS is_unique
FROM steps
"""


def words(text: Column) -> Column:
    """Maximal runs of anything but space and the controls 9 to 13."""
    spaced = F.translate(text, BLANKS, " " * len(BLANKS))
    return F.filter(F.split(spaced, " ", -1), lambda w: w != "")


def text_failures(text: Column) -> Column:
    """Bits of the filters that need the text alone, A to D."""

    def bits(found: Column) -> Column:
        total, kinds = F.size(found), F.size(F.array_distinct(found))
        capitals = F.length(F.regexp_replace(text, "[^A-Z]++", ""))
        fails = [
            total < LEAST_WORDS,
            kinds.cast("long") * 100 < total.cast("long") * DISTINCT_PERCENT,
            capitals.cast("long") * 100 > F.length(text).cast("long") * UPPER_PERCENT,
            F.rlike(text, F.lit(SYMBOLS)),
        ]
        return sum((F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(fails)), F.lit(0))

    return F.get(F.transform(F.array(words(text)), bits), F.lit(0))


def masked(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """``id, part, digest, mask`` of each document, the mask without the bit of equal texts."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        text.alias("text"),
    )
    return rows.select(
        "id", "part", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
        text_failures(F.col("text")).alias("mask"),
    )


def with_copies(rows: DataFrame) -> DataFrame:
    """Set the last bit of rows whose digest has a smaller id."""
    firsts = rows.where("id IS NOT NULL").groupBy("digest").agg(F.min("id").alias("id"))
    copy = F.col("id").isNotNull() & F.col("is_first").isNull()
    marked = rows.join(firsts.withColumn("is_first", F.lit(True)), ["id", "digest"], "left")
    bit = F.when(copy, F.lit(1 << LETTERS.index("E"))).otherwise(F.lit(0))
    return marked.select("id", "part", (F.col("mask") + bit).alias("mask"))


def labelled(rows: DataFrame, labels: DataFrame, id_col: str) -> DataFrame:
    """Add whether a document's labels call it good, and toxic."""
    of = labels.groupBy(F.col(id_col).alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    )
    none = F.lit(0)
    return rows.join(of, "id", "left").select(
        "part", "mask", F.coalesce("good", none).alias("good"), F.coalesce("toxic", none).alias("toxic")
    )


def cells(rows: DataFrame) -> DataFrame:
    """Documents for each part and mask: all, good and toxic ones. Parts are summed locally first."""
    return rows.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.sum("good").alias("n_good"), F.sum("toxic").alias("n_toxic")
    )


def prefixes(like: DataFrame) -> DataFrame:
    """Every prefix of an order, with what its last step does to each mask."""
    spark = like.sparkSession
    letters = ", ".join(f"('{c}', {1 << i})" for i, c in enumerate(LETTERS))
    values = f"(SELECT * FROM VALUES {letters} AS v(letter, bit))"
    return spark.sql(PREFIXES.format(letters=values, last=(1 << len(LETTERS)) - 1))


def orders(steps: DataFrame) -> DataFrame:
    """``prefix, filter_order``: each order with the five prefixes it has."""
    whole = steps.where(F.col("step") == len(LETTERS)).select(F.col("prefix").alias("filter_order")).distinct()
    return whole.select("filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS)))).alias("k")).select(
        F.expr("substring(filter_order, 1, k)").alias("prefix"), "filter_order"
    )


def filter_audit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
) -> DataFrame:
    """One row for each part, order and step: ``part, filter_order, step`` and the counts."""
    rows = labelled(with_copies(masked(docs, id_col, text_col, part_col)), labels, id_col)

    def total(value: str, where: str) -> Column:
        return F.sum(F.when(F.col(where), F.col(value)).otherwise(F.lit(0)))

    steps = prefixes(docs)
    per_prefix = (
        cells(rows)
        .join(F.broadcast(steps), "mask")
        .groupBy("part", "prefix", "step", "letter")
        .agg(
            total("n", "is_kept").alias("kept"),
            total("n", "is_removed").alias("removed"),
            total("n", "is_redundant").alias("redundant"),
            total("n", "is_unique").alias("unique_fails"),
            total("n_good", "is_removed").alias("good_lost"),
            total("n_toxic", "is_removed").alias("toxic_lost"),
        )
    )
    each = per_prefix.join(F.broadcast(orders(steps)), "prefix").drop("prefix")
    # The figures of a letter over all orders, of one part: 600 rows.
    shapley = each.groupBy("part", "letter").agg(F.sum("removed").alias("shapley"))
    return each.join(shapley, ["part", "letter"]).select("part", "filter_order", "step", *COUNTS, "shapley")
