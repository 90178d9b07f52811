"""Restoring: entity lists, the mapping store, and audits of the mapping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from maskwright.functions import placeholders
from maskwright.operators.audit import (
    audit_log,
    duplicate_mappings,
    leak_check,
    orphan_masked,
    unused_mapping,
)
from maskwright.operators.mask import (
    mapping_rows,
    mask_with_vault,
    take_apart,
    vault_rows,
)
from maskwright.operators.restore import grouped_mapping, restore, restore_with_mapping
from maskwright.plans import oracle as o
from maskwright.plans.mask_queries import masked_or_empty
from maskwright.plans.registry import query
from maskwright.plans.texts import CORPUS, LEADS, VISITS, corpus, leads, table, visits
from maskwright.sources.bucketed import orphan_rows, restore_tables, unused_rows, write_masked_tables
from maskwright.sources.staging import new_path, stage
from maskwright.sources.vault import read_vault, write_vault

KEYS = "src, id"

# What an outside step might answer: the masked text twice, a placeholder it made up (twice),
# one that only some rows have, and one with four digits.
REPLY = "concat('re: ', {0}, ' again ', {0}, ' <PHONE_999> <EMAIL_002> <PHONE_999> <DATE_1000>')"


def _replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    masked = masked_or_empty(corpus(spark, sf_dir), "t", ["src", "id"], entities_field="entities")
    return masked.withColumn("reply", F.expr(REPLY.format("coalesce(masked.masked_text, '')")))


# The same, from the unmasked text: placeholders of a row's own list come back as values.
_SECOND_MAIL = (
    "second AS (SELECT src, id, max(raw) AS mail FROM span WHERE placeholder = '<EMAIL_002>' "
    "GROUP BY src, id)"
)


def _restored_sql(select: str) -> str:
    return o.with_(
        o.spans(KEYS, CORPUS) + ", " + _SECOND_MAIL,
        f"SELECT src, id, {select} FROM src LEFT JOIN second USING (src, id)",
    )


_REPLY_BACK = (
    "replace(" + REPLY.format("t") + ", '<EMAIL_002>', coalesce(mail, '<EMAIL_002>')) "
    "AS restored_text"
)
_MADE_UP = (
    "CASE WHEN mail IS NULL THEN '<PHONE_999> <EMAIL_002>' ELSE '<PHONE_999>' END AS hallucinated"
)


@query("restore_text", _restored_sql(_REPLY_BACK))
def run_restore_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = placeholders.pairs_from_array(F.col("entities"))
    restored = placeholders.restore_text(F.col("reply"), pairs)
    return _replies(spark, sf_dir).select("src", "id", restored.alias("restored_text"))


@query("hallucinated", _restored_sql(_MADE_UP))
def run_hallucinated(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = restore(_replies(spark, sf_dir), "reply", "entities")
    return out.select("src", "id", F.array_join("restored.hallucinated", " ").alias("hallucinated"))


@query("restore", _restored_sql(f"{_REPLY_BACK}, {_MADE_UP}, 'regex' AS origin"))
def run_restore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entity list arrives as JSON text, as a workflow step would hand it on."""
    df = _replies(spark, sf_dir).withColumn("entities", F.to_json("entities"))
    return restore(df, "reply", "entities").select(
        "src",
        "id",
        "restored.restored_text",
        F.array_join("restored.hallucinated", " ").alias("hallucinated"),
        F.col("restored.source").alias("origin"),
    )


@query(
    "restore_chained",
    "SELECT c_custkey AS id, concat('to ', c_name, ' of ', c_name, ' and ', c_mktsegment) "
    "AS restored_text FROM customer",
)
def run_restore_chained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An original that holds a later placeholder is itself restored."""
    df = _customers(spark, sf_dir).selectExpr(
        "c_custkey AS id",
        "'to <NAME_001> and <ORG_001>' AS t",
        "array(named_struct('placeholder', '<NAME_001>', 'original', "
        "concat(c_name, ' of <NAME_002>')), named_struct('placeholder', '<NAME_002>', "
        "'original', c_name), named_struct('placeholder', '<ORG_001>', 'original', "
        "c_mktsegment)) AS entities",
    )
    return restore(df, "t").select("id", "restored.restored_text")


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_mktsegment")


# Every shape an entity list may arrive in.
_GOOD = '{{"placeholder":"<NAME_001>","original":"\', {name}, \'"}}'
_SHAPES = (
    "CASE c_custkey % 9 "
    "WHEN 0 THEN concat('[{good}]') "
    "WHEN 1 THEN concat('{good}') "
    "WHEN 2 THEN concat('[{good}') "
    "WHEN 3 THEN concat('[{{\"placeholder\":1,\"original\":\"x\"}},7,null,\"s\",[1],{good}]') "
    "WHEN 4 THEN NULL "
    "WHEN 5 THEN concat('[{{\"placeholder\":\"<NAME_001>\",\"original\":5}}]') "
    "WHEN 6 THEN concat('  [ {good} , {{\"original\":\"y\"}} ] ') "
    "WHEN 7 THEN concat('[{{\"placeholder\":\"<NAME_002>\",\"original\":\"old\",\"placeholder\":\"<NAME_001>\","
    "\"original\":\"a\\\\u0041\\\\n\"}},\"x\",{{\"placeholder\":\"<NAME_003>\"}}]') "
    "ELSE '' END"
).format(good=_GOOD.format(name="c_name"))


@query(
    "normalise_entities",
    "SELECT c_custkey AS id, CASE WHEN k IN (0, 3, 6, 8) THEN 1 ELSE 0 END AS kept, "
    "CASE k WHEN 3 THEN 5 WHEN 5 THEN 1 WHEN 6 THEN 1 WHEN 8 THEN 2 ELSE 0 END AS dropped, "
    "CASE WHEN k IN (0, 3, 6) THEN concat('Dear ', c_name) WHEN k = 8 THEN 'Dear aA' || chr(10) "
    "ELSE 'Dear <NAME_001>' END AS restored_text "
    "FROM (SELECT c_custkey, c_name, CASE c_custkey % 9 WHEN 7 THEN 8 WHEN 8 THEN 7 ELSE c_custkey % 9 END AS k "
    "FROM customer)",
)
def run_normalise_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _customers(spark, sf_dir).selectExpr(
        "c_custkey AS id", "'Dear <NAME_001>' AS t", f"{_SHAPES} AS entities"
    )
    kept = F.size(placeholders.pairs_from_json(F.col("entities"))).alias("kept")
    dropped = placeholders.dropped_elements(F.col("entities")).alias("dropped")
    return restore(df, "t").select("id", kept, dropped, "restored.restored_text")


# ---- the mapping, joined back ------------------------------------------------------------

_WRONG = "id % 7 = 3"  # rows that ask with another workspace's name


def _masked_and_vault(df: DataFrame, workspace: Column | None = None):
    """Both tables of a masked text, from one written scan."""
    both = mask_with_vault(df, "t", ["id"], workspace)
    return take_apart(stage(both, "masked"))


def _masked_and_vault_leads(spark: SparkSession, sf_dir: str):
    return _masked_and_vault(leads(spark, sf_dir), F.col("segment"))


def _vault_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vault_rows(leads(spark, sf_dir), "t", ["id"], workspace=F.col("segment"))


LEAD_ID = (
    "sha256(concat('{\"w\":\"', segment, '\",\"k0\":', id, ',\"t\":\"', sha256(t), '\"}'))"
)


@query(
    "restore_with_mapping",
    o.with_(
        o.masked("id", LEADS),
        f"SELECT id, CASE WHEN {_WRONG} THEN masked_text ELSE t END AS restored_text, "
        f"CASE WHEN {_WRONG} THEN (SELECT string_agg(placeholder, ' ' ORDER BY start) FROM span s "
        "WHERE s.id = masked.id) ELSE '' END AS hallucinated FROM masked",
    ),
)
def run_restore_with_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = F.when(F.expr(_WRONG), F.lit("ELSEWHERE")).otherwise(F.col("segment"))
    masked, vault = _masked_and_vault_leads(spark, sf_dir)
    out = restore_with_mapping(
        masked,
        vault,
        F.col("masked.masked_text"),
        F.col("masked.mapping_id"),
        workspace=asked,
    )
    return out.select(
        "id",
        "restored.restored_text",
        F.array_join("restored.hallucinated", " ").alias("hallucinated"),
    )


@query("restore_from_rows", f"SELECT id, t AS restored_text FROM ({VISITS})")
def run_restore_from_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mapping as one row per placeholder, with every row there twice."""
    masked, vault = _masked_and_vault(visits(spark, sf_dir))
    rows_ = mapping_rows(vault)
    out = restore_with_mapping(
        masked,
        rows_.unionByName(rows_),
        F.col("masked.masked_text"),
        F.col("masked.mapping_id"),
    )
    return out.select("id", "restored.restored_text")


@query(
    "mapping_store",
    o.with_(
        o.spans("id, segment, t", LEADS),
        f"SELECT segment AS workspace_id, {LEAD_ID} AS mapping_id, placeholder, category, "
        "raw AS original, start, stop AS \"end\" FROM span WHERE segment = 'BUILDING'",
    ),
)
def run_mapping_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "vault")
    write_vault(_vault_leads(spark, sf_dir), path)
    return mapping_rows(read_vault(spark, path, "BUILDING")).withColumns(
        {"start": F.col("start").cast("bigint"), "end": F.col("end").cast("bigint")}
    )


@query(
    "grouped_mapping",
    o.with_(
        o.spans("id, segment, t", LEADS),
        f"SELECT segment AS workspace_id, {LEAD_ID} AS mapping_id, "
        "string_agg(placeholder || '=' || raw, ' ' ORDER BY start) AS entities "
        "FROM span GROUP BY segment, id, t",
    ),
)
def run_grouped_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    vault = grouped_mapping(mapping_rows(_vault_leads(spark, sf_dir)))
    listed = F.transform("entities", lambda e: F.concat_ws("=", e["placeholder"], e["original"]))
    return vault.select("workspace_id", "mapping_id", F.array_join(listed, " ").alias("entities"))


@query(
    "grouped_mapping_first",
    o.with_(
        o.spans("id, t", VISITS),
        "SELECT id, t || ' ' || raw AS restored_text FROM span JOIN src USING (id, t) "
        "WHERE placeholder = '<EMAIL_001>'",
    ),
)
def run_grouped_mapping_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every placeholder comes with a second original further back, which does not count."""
    masked, vault = _masked_and_vault(visits(spark, sf_dir))
    rows_ = mapping_rows(vault)
    later = rows_.withColumns({"original": F.lit("wrong"), "start": F.col("start") + 100_000})
    masked = masked.withColumn("body", F.concat("masked.masked_text", F.lit(" <EMAIL_001>")))
    out = restore_with_mapping(
        masked.where("contains(masked.masked_text, '<EMAIL_001>')"), later.unionByName(rows_), "body",
        F.col("masked.mapping_id"),
    )
    return out.select("id", "restored.restored_text")


def _tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Leads as two bucketed tables, in folders of their own."""
    names = [new_path(spark, n) for n in ("maskedtable", "vaulttable")]
    tables = [n.rsplit("/", 1)[1].replace("-", "_") for n in names]
    write_masked_tables(
        leads(spark, sf_dir), *tables, "t", ["id"], BUCKETS, F.col("segment"), paths=tuple(names)
    )
    return spark.table(tables[0]), spark.table(tables[1])


BUCKETS = 8


@query(
    "restore_bucketed",
    o.with_(
        o.masked("id", LEADS),
        "SELECT id, segment AS workspace_id, CASE WHEN segment = 'MACHINERY' THEN masked_text ELSE t END "
        "AS restored_text FROM masked",
    ),
)
def run_restore_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tables have one layout; one workspace's mapping is missing."""
    masked, vault = _tables(spark, sf_dir)
    out = restore_tables(masked, vault.where("workspace_id <> 'MACHINERY'"))
    return out.select("id", "workspace_id", "restored.restored_text")


@query(
    "orphans_and_unused_bucketed",
    f"SELECT CASE WHEN segment = 'MACHINERY' THEN 'orphan' ELSE 'unused' END AS kind, {LEAD_ID} AS mapping_id "
    f"FROM ({LEADS}) WHERE segment IN ('MACHINERY', 'BUILDING')",
)
def run_orphans_and_unused_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    masked, vault = _tables(spark, sf_dir)
    left = orphan_rows(masked, vault.where("workspace_id <> 'MACHINERY'"))
    free = unused_rows(masked.where("workspace_id <> 'BUILDING'"), vault)
    return left.select(F.lit("orphan").alias("kind"), "mapping_id").unionByName(
        free.select(F.lit("unused").alias("kind"), "mapping_id")
    )


@query("orphan_masked", f"SELECT id FROM ({LEADS}) WHERE {_WRONG} OR segment = 'MACHINERY'")
def run_orphan_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = F.when(F.expr(_WRONG), F.lit("ELSEWHERE")).otherwise(F.col("segment"))
    masked, vault = _masked_and_vault_leads(spark, sf_dir)
    return orphan_masked(
        masked,
        vault.where("workspace_id <> 'MACHINERY'"),
        F.col("masked.masked_text"),
        F.col("masked.mapping_id"),
        asked,
    ).select("id")


@query(
    "unused_mapping",
    f"SELECT segment AS workspace_id, {LEAD_ID} AS mapping_id FROM ({LEADS}) "
    f"WHERE {_WRONG} OR segment = 'MACHINERY'",
)
def run_unused_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = F.when(F.expr(_WRONG), F.lit("ELSEWHERE")).otherwise(F.col("segment"))
    masked, vault = _masked_and_vault_leads(spark, sf_dir)
    known = masked.where("segment <> 'MACHINERY'")
    unused = unused_mapping(known, vault, F.col("masked.mapping_id"), asked)
    return unused.select("workspace_id", "mapping_id")


@query(
    "duplicate_mappings",
    f"SELECT segment AS workspace_id, {LEAD_ID} AS mapping_id, 2 AS copies FROM ({LEADS}) "
    "WHERE segment = 'HOUSEHOLD'",
)
def run_duplicate_mappings(spark: SparkSession, sf_dir: str) -> DataFrame:
    vault = stage(_vault_leads(spark, sf_dir), "vault")
    return duplicate_mappings(vault.unionByName(vault.where("workspace_id = 'HOUSEHOLD'")))


@query(
    "audit_log",
    o.with_(
        o.spans("id, segment, t", LEADS),
        f"SELECT segment AS workspace_id, {LEAD_ID} AS mapping_id, category, count(*) AS masked "
        "FROM span GROUP BY segment, id, t, category",
    ),
)
def run_audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_log(_vault_leads(spark, sf_dir))


@query(
    "leak_check",
    o.with_(
        o.masked("id", VISITS),
        "SELECT 'default' AS workspace_id, sha256(concat('{\"w\":\"default\",\"k0\":', id, "
        "',\"t\":\"', sha256(t), '\"}')) AS mapping_id, category, placeholder FROM span JOIN masked USING (id) "
        "WHERE contains(concat(masked_text, CASE WHEN id % 5 = 0 THEN t ELSE '' END), raw)",
    ),
)
def run_leak_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some rows are made to leak by adding the raw text again."""
    masked, vault = _masked_and_vault(visits(spark, sf_dir).withColumn("raw", F.col("t")))
    sent = masked.select(
        F.expr("concat(masked.masked_text, CASE WHEN id % 5 = 0 THEN raw ELSE '' END)").alias(
            "body"
        ),
        "masked.mapping_id",
    )
    return leak_check(sent, vault, "body")
