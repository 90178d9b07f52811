"""Audits of rows and datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from maskwright.operators.audit import dataset_audit, row_audit, summarise_entities
from maskwright.operators.detect import detect
from maskwright.operators.mask import mask
from maskwright.plans import oracle as o
from maskwright.plans.registry import query
from maskwright.plans.texts import CORPUS, LEAD, VISITS, corpus, documents, table, visits
from maskwright.sources.staging import new_path
from maskwright.sources.tables import write_routed

KEYS = "src, id"
DOCUMENTS = "SELECT doc_id AS id, text AS t, lang, source FROM documents"


def _flat_counts(df: DataFrame) -> Column:
    shown = F.transform(
        "pii.found_pii",
        lambda f: F.concat(
            f["category"], F.lit("="), f["count"].cast("string"), F.lit("["),
            F.array_join(f["samples"], " "), F.lit("]"),
        ),
    )
    return F.array_join(shown, "; ").alias("found_pii")


@query(
    "summarise_entities",
    o.with_(
        o.spans("id", VISITS)
        + ", counted AS (SELECT id, category, min(start) AS first, count(*) AS n, "
        "array_to_string(list(placeholder ORDER BY start)[1:3], ' ') AS samples FROM span "
        "WHERE category IN ('CARD', 'DATE', 'EMAIL', 'IP') GROUP BY id, category)",
        "SELECT id, string_agg(category || '=' || cast(n AS varchar) || '[' || samples || ']', "
        "'; ' ORDER BY first) AS found_pii, cast(sum(n) AS bigint) AS total_count "
        "FROM counted GROUP BY id",
    ),
)
def run_summarise_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filter is case-sensitive on lists, so ``url`` finds nothing."""
    masked = mask(visits(spark, sf_dir), "t", ["id"])
    out = summarise_entities(
        masked, F.col("masked.entities"), ["DATE", "EMAIL", "IP", "CARD", "url"]
    )
    return out.select("id", _flat_counts(out), F.col("pii.total_count").cast("bigint").alias(
        "total_count"
    ))


_ROW = (
    "concat('{\"c_custkey\":', c_custkey, ',\"c_name\":\"', c_name, '\",\"segment\":', "
    "CASE WHEN c_nationkey < 5 THEN 'null' ELSE '\"' || c_mktsegment || '\"' END, "
    "',\"note\":\"', {lead}, '\"}')"
).replace("{lead}", LEAD)


@query(
    "row_audit",
    o.with_(
        o.found("id", f"SELECT c_custkey AS id, {_ROW} AS t FROM customer"),
        "SELECT id AS c_custkey, category, count(*) AS hits FROM hit "
        "WHERE category IN ('INN', 'SNILS', 'CARD', 'EMAIL', 'PHONE') GROUP BY id, category",
    ),
)
def run_row_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every field of a row is scanned, through the row's JSON."""
    customers = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    df = customers.selectExpr(
        "c_custkey",
        "c_name",
        "CASE WHEN c_nationkey >= 5 THEN c_mktsegment END AS segment",
        f"{LEAD} AS note",
    )
    out = row_audit(df, ["INN", "SNILS", "CARD", "EMAIL", "PHONE"])
    return out.select("c_custkey", F.explode("pii.found_pii").alias("f")).select(
        "c_custkey", "f.category", F.col("f.count").cast("bigint").alias("hits")
    )


@query(
    "row_audit_numbers",
    o.with_(
        o.found(
            "id",
            "SELECT c_custkey AS id, concat('{\"c_custkey\":', c_custkey, ',\"inn\":', 7700000000 + c_custkey, "
            "',\"more\":{\"card\":', 4111111111110000 + c_custkey, ',\"half\":0.5},\"any\":{\"other\":', "
            "4111111111120000 + c_custkey, '}}') AS t FROM customer",
            ["INN", "CARD"],
        ),
        "SELECT id AS c_custkey, category, count(*) AS hits FROM hit GROUP BY id, category",
    ),
)
def run_row_audit_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers in double columns, in structs and maps too, are scanned as they would be typed."""
    df = table(spark, sf_dir, "customer", "c_custkey").selectExpr(
        "c_custkey",
        "cast(7700000000 + c_custkey AS double) AS inn",
        "named_struct('card', cast(4111111111110000 + c_custkey AS double), 'half', 0.5D) AS more",
        "map('other', cast(4111111111120000 + c_custkey AS double)) AS any",
    )
    return row_audit(df, ["INN", "CARD"]).select("c_custkey", F.explode("pii.found_pii").alias("f")).select(
        "c_custkey", "f.category", F.col("f.count").cast("bigint").alias("hits")
    )


@query(
    "flag_split",
    o.with_(
        o.found(KEYS, CORPUS),
        "SELECT src, flagged, count(*) AS n FROM (SELECT src.src, EXISTS (SELECT 1 FROM hit "
        "WHERE hit.src = src.src AND hit.id = src.id) AS flagged FROM src) GROUP BY src, flagged",
    ),
)
def run_flag_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides are written from one scan, each into a folder of its own."""
    found = detect(corpus(spark, sf_dir), "t", include_samples=False, on_error="keep").drop("t", "error")
    path = new_path(spark, "split")
    write_routed(found, path, F.when(F.col("pii.total_count") > 0, "flagged").otherwise("rest"))
    sides = [
        spark.read.schema(found.schema).parquet(f"{path}/route={side}").select("src", F.lit(flag).alias("flagged"))
        for side, flag in (("flagged", True), ("rest", False))
    ]
    return sides[0].unionByName(sides[1]).groupBy("src", "flagged").agg(F.count("*").alias("n"))


def _audit_sql(grouping: str, level: str) -> str:
    """Groups are counted apart from hits, since a group may have rows without any."""
    return o.with_(
        o.found("id", DOCUMENTS)
        + ", per_row AS (SELECT id, category, count(*) AS n FROM hit GROUP BY id, category)"
        + f", scanned AS (SELECT lang, source, {level} AS level, count(*) AS rows_scanned "
        f"FROM src GROUP BY {grouping})"
        + f", hits AS (SELECT lang, source, {level} AS level, category, "
        "cast(sum(n) AS bigint) AS hits, count(*) AS rows_with_hits FROM per_row JOIN src "
        f"USING (id) GROUP BY category, {grouping})",
        "SELECT lang, source, level, rows_scanned, category, hits, rows_with_hits FROM hits "
        "JOIN scanned USING (level) WHERE hits.lang IS NOT DISTINCT FROM scanned.lang "
        "AND hits.source IS NOT DISTINCT FROM scanned.source",
    ).replace("SELECT lang, source, level, rows", "SELECT hits.lang, hits.source, level, rows")


def _audit(spark: SparkSession, sf_dir: str, grouping: str) -> DataFrame:
    out = dataset_audit(documents(spark, sf_dir), ["lang", "source"], "text", grouping=grouping, on_error="keep")
    return out.withColumn(
        "level", F.col("level").cast("bigint") if "level" in out.columns else F.lit(0).cast("bigint")
    )


_GROUPING = "cast(2 * grouping(lang) + grouping(source) AS bigint)"


@query("dataset_audit", _audit_sql("lang, source", "cast(0 AS bigint)"))
def run_dataset_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _audit(spark, sf_dir, "group")


@query("dataset_audit_rollup", _audit_sql("ROLLUP (lang, source)", _GROUPING))
def run_dataset_audit_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _audit(spark, sf_dir, "rollup")


@query("dataset_audit_cube", _audit_sql("CUBE (lang, source)", _GROUPING))
def run_dataset_audit_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _audit(spark, sf_dir, "cube")


@query(
    "dataset_audit_labels",
    o.with_(
        o.found("id", DOCUMENTS),
        "SELECT quality, toxic, category, count(*) AS hits, "
        "count(DISTINCT id) AS rows_with_hits FROM hit LEFT JOIN labels ON labels.doc_id = hit.id "
        "GROUP BY quality, toxic, category",
    ),
)
def run_dataset_audit_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts are scanned; labels are joined to their counts. Unlabelled ones are a group."""
    texts = documents(spark, sf_dir).select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    out = dataset_audit(texts, ["quality", "toxic"], "text", labels=labels, key=["doc_id"], on_error="keep")
    return out.select("quality", "toxic", "category", "hits", "rows_with_hits")


# The same under the name that it had beside the inner join which `dataset_audit_labels` once was.
@query(
    "dataset_audit_all_labels",
    o.with_(
        o.found("id", DOCUMENTS),
        "SELECT quality, toxic, category, count(*) AS hits, "
        "count(DISTINCT id) AS rows_with_hits FROM hit LEFT JOIN labels ON labels.doc_id = hit.id "
        "GROUP BY quality, toxic, category",
    ),
)
def run_dataset_audit_all_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts are scanned; those without labels are a group of their own."""
    texts = documents(spark, sf_dir).select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    out = dataset_audit(texts, ["quality", "toxic"], "text", labels=labels, key=["doc_id"], on_error="keep")
    return out.select("quality", "toxic", "category", "hits", "rows_with_hits")
