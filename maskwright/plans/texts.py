"""Text columns over the given tables, as SQL that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskwright.sources.tables import read_parquet


def _pad(value: str, width: int) -> str:
    return f"lpad(cast({value} as string), {width}, '0')"


# A sales lead per customer: each category but cards and addresses, once.
LEAD = (
    "concat('Lead ', c_name, ', mail user', cast(c_custkey as string), '@example.ru, phone +7 (9', "
    f"{_pad('c_custkey % 100', 2)}, ') ', {_pad('c_custkey % 1000', 3)}, '-45-', "
    f"{_pad('c_custkey % 97', 2)}, '; SNILS 112-233-', {_pad('c_custkey % 1000', 3)}, "
    "' 95; INN ', cast(7700000000 + c_custkey as string), "
    "'; site https://shop.example.ru/', cast(c_custkey as string), ' on ', "
    f"{_pad('1 + c_custkey % 28', 2)}, '.05.2026.')"
)

# A visit per order, full of shapes that overlap: an address and a date inside a URL, a phone
# that may also be a card, an insurance number inside a longer card, a card before a year.
VISIT = (
    "concat('order ', cast(o_orderkey as string), ': see https://u', cast(o_custkey as string), "
    f"'@host.ru/x?', {_pad('1 + o_orderkey % 28', 2)}, '.', {_pad('1 + o_custkey % 12', 2)}, "
    "'.2026 from 10.', cast(o_orderkey % 256 as string), '.', cast(o_custkey % 300 as string), "
    f"'.7; call 8 495 ', {_pad('o_orderkey % 1000', 3)}, ' ', {_pad('o_custkey % 100', 2)}, ' ', "
    f"{_pad('o_orderkey % 100', 2)}, ' ', {_pad('o_orderkey % 10000', 4)}, "
    f"'; pay 4111 1111 1111 ', {_pad('o_orderkey % 10000', 4)}, ' ', "
    "cast(2020 + o_custkey % 7 as string), '; id ', "
    f"{_pad('o_orderkey % 100', 2)}, ' 112-233-', {_pad('o_custkey % 1000', 3)}, ' ', "
    f"{_pad('o_orderkey % 97', 2)}, ', inn ', cast(500100000000 + o_orderkey as string), "
    "', mail a', cast(o_custkey as string), '@x.ru,b', cast(o_orderkey as string), "
    "'.c@y-z.com_ on ', cast(1 + o_orderkey % 31 as string), '/', "
    "cast(1 + o_custkey % 12 as string), '/', cast(1990 + o_orderkey % 45 as string))"
)

LEADS = f"SELECT c_custkey AS id, c_mktsegment AS segment, {LEAD} AS t FROM customer"
VISITS = f"SELECT o_orderkey AS id, {VISIT} AS t FROM orders"

CORPUS = f"""
    SELECT 'documents' AS src, doc_id AS id, text AS t FROM documents
    UNION ALL SELECT 'leads', c_custkey, {LEAD} FROM customer
    UNION ALL SELECT 'visits', o_orderkey, {VISIT} FROM orders
    UNION ALL SELECT 'pages', page_id, concat(url, ' ', html) FROM pages
    UNION ALL SELECT 'conversations', conv_id * 10000 + turn, text FROM conversations
"""


# A caller with files of one split each may ask for this many tasks; never set by the library.
PARTITIONS = "spark.maskwright.inputPartitions"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = read_parquet(spark, f"{sf_dir}/{name}.parquet", list(columns) or None)
    partitions = spark.conf.get(PARTITIONS, None)
    return df.repartition(int(partitions)) if partitions else df


def spread(df: DataFrame) -> DataFrame:
    """Deal narrow rows out over many tasks, before long texts are made of them.

    A row group of a file is read by one task, and a million keys fit into one. A row's key is a seeded
    number, so rows that repeat each other go to different tasks, and a row to the same one if it is read
    again.
    """
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return df.repartition(tasks, F.rand(0))


def leads(spark: SparkSession, sf_dir: str, text: str = LEAD) -> DataFrame:
    df = spread(table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_mktsegment"))
    return df.selectExpr("c_custkey AS id", "c_mktsegment AS segment", f"{text} AS t")


def visits(spark: SparkSession, sf_dir: str, text: str = VISIT) -> DataFrame:
    df = spread(table(spark, sf_dir, "orders", "o_orderkey", "o_custkey"))
    return df.selectExpr("o_orderkey AS id", f"{text} AS t")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")


def _filled(text: str) -> str:
    """A text that is put together without its nulls, as in DuckDB; of one null Spark makes all of it null."""
    return text.replace("concat(", "concat_ws('', ", 1)


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text in the given tables: src, id, t. Documents and turns may have a null or empty one."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "text")
    return (
        docs.selectExpr("'documents' AS src", "doc_id AS id", "text AS t")
        .unionByName(leads(spark, sf_dir, _filled(LEAD)).selectExpr("'leads' AS src", "id", "t"))
        .unionByName(visits(spark, sf_dir, _filled(VISIT)).selectExpr("'visits' AS src", "id", "t"))
        .unionByName(
            pages.selectExpr("'pages' AS src", "page_id AS id", f"{_filled("concat(url, ' ', html)")} AS t")
        )
        .unionByName(
            turns.selectExpr("'conversations' AS src", "conv_id * 10000 + turn AS id", "text AS t")
        )
    )
