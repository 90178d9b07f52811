"""Masking: overlaps, numbering, masked text, ids, and the rules for bad rows."""

from __future__ import annotations

import re

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskwright.functions import rows
from maskwright.functions.placeholders import preexisting_placeholder
from maskwright.operators.detect import detect_counts
from maskwright.operators.mask import mask, mask_entities, with_mapping_id
from maskwright.plans import oracle as o
from maskwright.plans.registry import query
from maskwright.plans.texts import CORPUS, LEAD, corpus, documents, spread, table
from maskwright.sources.staging import new_path
from maskwright.sources.vault import write_masked

KEYS = "src, id"
CORPUS_ID = (
    "sha256(concat('{\"w\":\"default\",\"k0\":\"', src, '\",\"k1\":', id, ',\"t\":\"', "
    "sha256(t), '\"}'))"
)


def masked_or_empty(df: DataFrame, text: str, key: list[str], **options) -> DataFrame:
    """:func:`mask` over rows of which some have no text, as the SQL has it: nothing to mask in them,
    and an id and tags as for all others. Where there is a text, nothing but its masked form counts."""
    out = mask(df, text, key, on_error="keep", **options).drop("error")
    nothing = F.struct(
        F.when(F.col(text) == "", F.lit("")).alias("masked_text"),
        rows.mapping_id(rows.workspace(None), key, text).alias("mapping_id"),
        F.array().alias("entities"),
        F.lit(options.get("policy", "balanced")).alias("policy"),
        F.lit(rows.SOURCE).alias("source"),
    ).cast(out.schema["masked"].dataType)
    return out.withColumn("masked", F.when(rows.is_filled(F.col(text)), F.col("masked")).otherwise(nothing))


def _masked(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return masked_or_empty(corpus(spark, sf_dir), "t", ["src", "id"], **options)


def _spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = _masked(spark, sf_dir, entities_field="entities")
    return wide.select("src", "id", F.inline("entities"))


@query(
    "resolve_overlaps",
    o.with_(
        o.spans(KEYS, CORPUS), 'SELECT src, id, category, start, stop AS "end" FROM span'
    ),
)
def run_resolve_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spans(spark, sf_dir).select(
        "src",
        "id",
        "category",
        F.col("start").cast("bigint").alias("start"),
        F.col("end").cast("bigint").alias("end"),
    )


@query(
    "number_placeholders",
    o.with_(o.spans(KEYS, CORPUS), "SELECT src, id, placeholder, start FROM span"),
)
def run_number_placeholders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spans(spark, sf_dir).select(
        "src", "id", "placeholder", F.col("start").cast("bigint").alias("start")
    )


@query(
    "mask_text", o.with_(o.masked(KEYS, CORPUS), "SELECT src, id, masked_text FROM masked")
)
def run_mask_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _masked(spark, sf_dir).select("src", "id", "masked.masked_text")


@query(
    "mask_entities",
    o.with_(
        o.spans(f"{KEYS}, t", CORPUS),
        f"SELECT 'default' AS workspace_id, {CORPUS_ID} AS mapping_id, placeholder, category, "
        'raw AS original, start, stop AS "end" FROM span',
    ),
)
def run_mask_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows_ = mask_entities(corpus(spark, sf_dir), "t", ["src", "id"], on_error="keep")
    return rows_.withColumns(
        {"start": F.col("start").cast("bigint"), "end": F.col("end").cast("bigint")}
    )


@query(
    "mask",
    o.with_(
        o.masked(KEYS, CORPUS)
        + ", listed_entities AS (SELECT src, id, string_agg(placeholder || ':' || category, ' ' "
        "ORDER BY start) AS entities FROM span GROUP BY src, id)",
        f"SELECT src, id, t, masked_text, {CORPUS_ID} AS mapping_id, "
        "coalesce(entities, '') AS entities, 'strict' AS policy, 'regex' AS origin "
        "FROM masked LEFT JOIN listed_entities USING (src, id)",
    ),
)
def run_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = F.transform(
        "masked.entities", lambda e: F.concat_ws(":", e["placeholder"], e["category"])
    )
    return _masked(spark, sf_dir, policy="strict").select(
        "src",
        "id",
        "t",
        "masked.masked_text",
        "masked.mapping_id",
        F.array_join(listed, " ").alias("entities"),
        "masked.policy",
        F.col("masked.source").alias("origin"),
    )


@query(
    "public_entities",
    o.with_(
        o.spans(KEYS, CORPUS),
        "SELECT src, id, placeholder, category, cast(0.7 AS double) AS confidence FROM span",
    ),
)
def run_public_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _masked(spark, sf_dir).select("src", "id", F.inline("masked.entities"))


@query("mapping_id", f"SELECT src, id, {CORPUS_ID} AS mapping_id FROM ({CORPUS})")
def run_mapping_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row without a text has an id, too."""
    ids = with_mapping_id(corpus(spark, sf_dir), "t", ["src", "id"], on_error="keep")
    own = rows.mapping_id(rows.workspace(None), ["src", "id"], "t")
    return ids.select("src", "id", F.coalesce("mapping_id", own).alias("mapping_id"))


@query(
    "policy_source",
    f"SELECT 'permissive' AS policy, 'regex' AS origin, count(*) AS n FROM ({CORPUS})",
)
def run_policy_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = _masked(spark, sf_dir, policy="permissive").select("masked.policy", "masked.source")
    return tags.groupBy("policy", F.col("source").alias("origin")).agg(F.count("*").alias("n"))


@query(
    "number_past_999",
    "SELECT s_suppkey AS id, '<EMAIL_' || CASE WHEN i < 1000 THEN lpad(CAST(i AS VARCHAR), 3, '0') "
    "ELSE CAST(i AS VARCHAR) END || '>' AS placeholder, "
    "'u' || s_suppkey || '.' || i || '@x.ru' AS original "
    "FROM supplier, unnest(range(1, 1002)) AS n(i)",
)
def run_number_past_999(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text of 1,001 addresses for each supplier, put together in its row."""
    texts = spread(table(spark, sf_dir, "supplier", "s_suppkey")).selectExpr(
        "s_suppkey AS id",
        "array_join(transform(sequence(1, 1001), i -> "
        "concat('u', cast(s_suppkey AS string), '.', cast(i AS string), '@x.ru')), ' ') AS t",
    )
    return mask(texts, "t", ["id"], entities_field="e").select("id", F.inline("e")).select(
        "id", "placeholder", "original"
    )


# Three kinds of bad rows among good ones: null, empty, and good.
GAPPY = (
    "CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE {lead} END"
).format(lead=LEAD)
GAPPY_SQL = f"SELECT c_custkey AS id, {GAPPY} AS t FROM customer"


def _gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "customer", "c_custkey", "c_name")
    return df.selectExpr("c_custkey AS id", f"{GAPPY} AS t")


@query(
    "reject_empty",
    "SELECT error, count(*) AS n FROM (SELECT CASE WHEN coalesce(t, '') = '' "
    f"THEN '{rows.MASK_TEXT_EMPTY}' END AS error FROM ({GAPPY_SQL})) GROUP BY error",
)
def run_reject_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = mask(_gappy(spark, sf_dir), "t", ["id"], on_error="keep")
    return kept.groupBy("error").agg(F.count("*").alias("n"))


@query(
    "on_error_keep",
    o.with_(
        o.masked("id", GAPPY_SQL),
        "SELECT id, CASE WHEN coalesce(t, '') <> '' THEN masked_text END AS masked_text, "
        f"CASE WHEN coalesce(t, '') = '' THEN '{rows.MASK_TEXT_EMPTY}' END AS error FROM masked",
    ),
)
def run_on_error_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = mask(_gappy(spark, sf_dir), "t", ["id"], on_error="keep")
    return kept.select("id", "masked.masked_text", "error")


@query(
    "on_error_fail",
    o.with_(
        o.masked("id", f"SELECT * FROM ({GAPPY_SQL}) WHERE t <> ''"),
        "SELECT id % 5 AS kind, id, masked_text, NULL AS ended_by, false AS names_a_bad_row FROM masked UNION ALL "
        f"SELECT DISTINCT id % 5, NULL, NULL, '{rows.MASK_TEXT_EMPTY}', true FROM ({GAPPY_SQL}) WHERE id % 5 < 2",
    ),
)
def run_on_error_fail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good rows are masked, each of them. Bad ones end the run and are named: each kind is one of its own."""
    all_rows = _gappy(spark, sf_dir)
    report = []
    for kind in range(2):
        try:
            mask(all_rows.where(F.col("id") % 5 == kind), "t", ["id"]).select("masked").count()
        except PySparkException as error:
            said = str(error)
            named = re.search(r'Row \{"id":([0-9]+)\}', said)
            known = rows.MASK_TEXT_EMPTY if rows.MASK_TEXT_EMPTY in said else said
            report.append((kind, None, None, known, named is not None and int(named[1]) % 5 == kind))
    good = mask(all_rows.where("t <> ''"), "t", ["id"]).select(
        (F.col("id") % 5).cast("bigint").alias("kind"), "id", "masked.masked_text",
        F.lit(None).cast("string").alias("ended_by"), F.lit(False).alias("names_a_bad_row"),
    )
    ended = "kind long, id long, masked_text string, ended_by string, names_a_bad_row boolean"
    return good.unionByName(spark.createDataFrame(report, ended))


@query(
    "rejects",
    o.with_(
        o.masked("id", GAPPY_SQL),
        "SELECT id, CASE WHEN coalesce(t, '') <> '' THEN masked_text END AS masked_text, "
        f"CASE WHEN coalesce(t, '') = '' THEN '{rows.MASK_TEXT_EMPTY}' END AS error, "
        "CASE WHEN coalesce(t, '') = '' THEN count(*) FILTER (coalesce(t, '') = '') OVER () "
        "ELSE count(*) FILTER (coalesce(t, '') <> '') OVER () END AS alike FROM masked",
    ),
)
def run_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad rows become a table of their own, from the scan that masks the others; both are counted."""
    paths = [new_path(spark, n) for n in ("masked", "vault", "rejects")]
    counts = write_masked(_gappy(spark, sf_dir), *paths[:2], "t", ["id"], rejects_path=paths[2])
    masked = spark.read.parquet(paths[0]).select(
        "id", "masked.masked_text", F.lit(None).cast("string").alias("error"),
        F.lit(counts["masked"]).alias("alike"),
    )
    rejected = spark.read.parquet(paths[2]).select(
        "id", F.lit(None).cast("string").alias("masked_text"), "error", F.lit(counts["rejected"]).alias("alike")
    )
    return masked.unionByName(rejected)


@query(
    "skip_bad_rows",
    o.with_(
        o.found("id", f"SELECT * FROM ({GAPPY_SQL}) WHERE t <> ''"),
        "SELECT id, category, count(*) AS hits FROM hit GROUP BY id, category",
    ),
)
def run_skip_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect_counts(_gappy(spark, sf_dir), ["id"], "t", on_error="skip")


@query(
    "passthrough",
    o.with_(
        o.masked("c_custkey", f"SELECT *, {LEAD} AS t FROM customer"),
        "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, t, masked_text "
        "FROM masked",
    ),
)
def run_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows_ = table(spark, sf_dir, "customer").selectExpr("*", f"{LEAD} AS t")
    out = mask(rows_, "t", ["c_custkey"])
    return out.select(*rows_.columns, "masked.masked_text")


@query(
    "workspace",
    "SELECT id, coalesce(nullif(a, ''), nullif(b, ''), 'default') AS workspace_id FROM ("
    "SELECT c_custkey AS id, CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN c_mktsegment END AS a, "
    "CASE WHEN c_nationkey > 12 THEN '' ELSE concat('n', cast(c_nationkey AS varchar)) END AS b "
    "FROM customer)",
)
def run_workspace(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment", "c_nationkey")
    choices = df.selectExpr(
        "c_custkey AS id",
        "CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN c_mktsegment END AS a",
        "CASE WHEN c_nationkey > 12 THEN '' ELSE concat('n', cast(c_nationkey AS string)) END AS b",
    )
    return choices.select("id", rows.workspace(F.col("a"), F.col("b")).alias("workspace_id"))


@query(
    "preexisting_placeholder",
    "SELECT id, regexp_matches(t, '<[A-Z]+_[0-9]{3,}>') AS taken FROM (SELECT c_custkey AS id, "
    f"concat({LEAD}, CASE WHEN c_nationkey % 4 = 0 THEN ' see <EMAIL_001>' "
    "WHEN c_nationkey % 4 = 1 THEN ' see <EMAIL_01>' ELSE '' END) AS t FROM customer)",
)
def run_preexisting_placeholder(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey")
    texts = df.selectExpr(
        "c_custkey AS id",
        f"concat({LEAD}, CASE WHEN c_nationkey % 4 = 0 THEN ' see <EMAIL_001>' "
        "WHEN c_nationkey % 4 = 1 THEN ' see <EMAIL_01>' ELSE '' END) AS t",
    )
    return texts.select("id", preexisting_placeholder(F.col("t")).alias("taken"))


@query(
    "mask_documents",
    o.with_(
        o.masked("id", "SELECT doc_id AS id, text AS t FROM documents"),
        "SELECT id AS doc_id, masked_text FROM masked",
    ),
)
def run_mask_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    masked = masked_or_empty(documents(spark, sf_dir), "text", ["doc_id"])
    return masked.select("doc_id", "masked.masked_text")
