"""Finding: one query per category, checksums, and detection per row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskwright.functions.catalogue import CATEGORIES
from maskwright.functions.checksums import inn_valid, luhn_valid
from maskwright.functions.rows import SOURCE
from maskwright.operators.detect import (
    detect,
    detect_counts,
    detect_samples,
    hits,
    hits_long,
)
from maskwright.plans import oracle as o
from maskwright.plans.registry import query
from maskwright.plans.texts import CORPUS, corpus, documents, table

KEYS = "src, id"

# The given tables may hold rows without a text. They count as read and have no hits, as in the SQL; a
# run over millions of texts does not end for one of them.
KEEP = "keep"


def _register_category(name: str) -> None:
    ctes = o.found(KEYS, CORPUS, [name])

    @query(f"hit_{name.lower()}", o.with_(ctes, 'SELECT src, id, start, stop AS "end", raw FROM hit'))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = hits_long(corpus(spark, sf_dir), "t", [name], KEEP)
        return found.select(
            "src",
            "id",
            F.col("start").cast("bigint").alias("start"),
            F.col("end").cast("bigint").alias("end"),
            "raw",
        )


for _category in CATEGORIES:
    _register_category(_category.name)


_INNS = "SELECT c_custkey AS id, cast(7700000000 + c_custkey AS varchar) AS v FROM customer"
_INNS_12 = "SELECT o_orderkey, cast(500100000000 + o_orderkey AS varchar) FROM orders"


@query(
    "inn_valid",
    f"SELECT id, v, {o.inn_valid('v')} AS valid FROM ({_INNS} UNION ALL {_INNS_12})",
)
def run_inn_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    tens = table(spark, sf_dir, "customer", "c_custkey").selectExpr(
        "c_custkey AS id", "cast(7700000000 + c_custkey AS string) AS v"
    )
    twelves = table(spark, sf_dir, "orders", "o_orderkey").selectExpr(
        "o_orderkey AS id", "cast(500100000000 + o_orderkey AS string) AS v"
    )
    return tens.unionByName(twelves).select("id", "v", inn_valid(F.col("v")).alias("valid"))


@query(
    "luhn_valid",
    "SELECT id, line, v, " + o.luhn_valid("v") + " AS valid FROM (SELECT l_orderkey AS id, "
    "l_linenumber AS line, concat('4111-', lpad(cast(l_partkey AS varchar), 8, '0'), ' ', "
    "cast(l_orderkey AS varchar)) AS v FROM lineitem)",
)
def run_luhn_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbers = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey")
    return numbers.selectExpr(
        "l_orderkey AS id",
        "l_linenumber AS line",
        "concat('4111-', lpad(cast(l_partkey AS string), 8, '0'), ' ', "
        "cast(l_orderkey AS string)) AS v",
    ).withColumn("valid", luhn_valid(F.col("v")))


@query(
    "hits_all",
    o.with_(
        o.found(KEYS, CORPUS), 'SELECT src, id, category, start, stop AS "end", raw FROM hit'
    ),
)
def run_hits_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hits_long(corpus(spark, sf_dir), "t", on_error=KEEP)
    return found.select(
        "src",
        "id",
        "category",
        F.col("start").cast("bigint").alias("start"),
        F.col("end").cast("bigint").alias("end"),
        "raw",
    )


@query(
    "category_filter",
    o.with_(
        o.found(KEYS, CORPUS, ["EMAIL", "SNILS"]),
        "SELECT src, category, count(*) AS hits FROM hit GROUP BY src, category",
    ),
)
def run_category_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lower case is accepted; NAME and IBAN are, too, and never hit."""
    counts = detect_counts(
        corpus(spark, sf_dir), ["src", "id"], "t", ["snils", "Email", "IBAN", "NAME"], KEEP
    )
    return counts.groupBy("src", "category").agg(F.sum("hits").alias("hits"))


@query(
    "order_hits",
    o.with_(
        o.found(KEYS, CORPUS),
        "SELECT src, id, string_agg(category || '@' || cast(start AS varchar), ' ' "
        "ORDER BY start, ord) AS sequence FROM hit GROUP BY src, id",
    ),
)
def run_order_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = hits(corpus(spark, sf_dir), "t", on_error=KEEP).where(F.size("hits") > 0)
    return ordered.select(
        "src",
        "id",
        F.array_join(
            F.transform("hits", lambda h: F.concat_ws("@", h["category"], h["start"])), " "
        ).alias("sequence"),
    )


@query(
    "detect_counts",
    o.with_(
        o.found(KEYS, CORPUS),
        "SELECT src, id, category, count(*) AS hits FROM hit GROUP BY src, id, category",
    ),
)
def run_detect_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect_counts(corpus(spark, sf_dir), ["src", "id"], "t", on_error=KEEP)


@query(
    "detect_samples",
    o.with_(
        o.found(KEYS, CORPUS),
        "SELECT src, id, category, rank, raw AS sample FROM (SELECT *, row_number() OVER ("
        "PARTITION BY src, id, category ORDER BY start) AS rank FROM hit) WHERE rank <= 3",
    ),
)
def run_detect_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect_samples(corpus(spark, sf_dir), ["src", "id"], "t", on_error=KEEP)


def _found_text(samples: bool) -> str:
    shown = "[' || array_to_string(list(raw ORDER BY start)[1:3], ' | ') || ']" if samples else "[]"
    return (
        f"SELECT {KEYS}, ord, category || '=' || cast(count(*) AS varchar) || '{shown}' AS part, "
        "count(*) AS n FROM hit GROUP BY src, id, ord, category"
    )


def _detect_sql(samples: bool) -> str:
    return o.with_(
        o.found(KEYS, CORPUS) + f", part AS ({_found_text(samples)})",
        "SELECT src, id, coalesce(string_agg(part, '; ' ORDER BY ord), '') AS found_pii, "
        "cast(coalesce(sum(n), 0) AS bigint) AS total_count, 'regex' AS origin "
        "FROM src LEFT JOIN part USING (src, id) GROUP BY src, id",
    )


def _flat(df: DataFrame) -> DataFrame:
    """Rows without a text have nothing."""
    shown = F.transform(
        "pii.found_pii",
        lambda f: F.concat(
            f["category"], F.lit("="), f["count"].cast("string"), F.lit("["),
            F.array_join(f["samples"], " | "), F.lit("]"),
        ),
    )
    return df.select(
        "src",
        "id",
        F.coalesce(F.array_join(shown, "; "), F.lit("")).alias("found_pii"),
        F.coalesce(F.col("pii.total_count"), F.lit(0)).cast("bigint").alias("total_count"),
        F.coalesce(F.col("pii.source"), F.lit(SOURCE)).alias("origin"),
    )


@query("detect", _detect_sql(samples=True))
def run_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(detect(corpus(spark, sf_dir), "t", on_error=KEEP))


@query("suppress_samples", _detect_sql(samples=False))
def run_suppress_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(detect(corpus(spark, sf_dir), "t", include_samples=False, on_error=KEEP))


_FLAGSHIP = "SELECT doc_id AS id, text AS t FROM documents"


@query(
    "detect_documents",
    o.with_(
        o.found("id", _FLAGSHIP, ["EMAIL", "CARD", "IP"]),
        "SELECT id AS doc_id, category, count(*) AS hits FROM hit GROUP BY id, category",
    ),
)
def run_detect_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect_counts(documents(spark, sf_dir), ["doc_id"], "text", ["EMAIL", "CARD", "IP"], KEEP)




@query(
    "detect_documents_all",
    o.with_(
        o.found("id", _FLAGSHIP),
        "SELECT id AS doc_id, category, count(*) AS hits FROM hit GROUP BY id, category",
    ),
)
def run_detect_documents_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect_counts(documents(spark, sf_dir), ["doc_id"], "text", on_error=KEEP)
