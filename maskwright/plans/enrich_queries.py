"""The round trip: mask, let something else answer, restore."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from maskwright.functions.messages import build_messages, first_choice, resolve_model
from maskwright.operators.enrich import private_enrich, private_enrich_column
from maskwright.operators.mask import mask
from maskwright.plans import oracle as o
from maskwright.plans.registry import query
from maskwright.plans.texts import LEADS, VISITS, leads, table, visits
from maskwright.sources.staging import stage

_ANSWER = "concat('re: ', {0}, ' cc <PHONE_999>')"


def _flat(df: DataFrame) -> DataFrame:
    return df.select(
        "id",
        "enriched.response",
        "enriched.masked_prompt",
        "enriched.masked_response",
        "enriched.model",
        F.array_join("enriched.hallucinated", " ").alias("hallucinated"),
        F.col("enriched.source").alias("origin"),
    )


def _round_trip_sql(source: str, model: str) -> str:
    return o.with_(
        o.masked("id", source),
        f"SELECT id, {_ANSWER.format('t')} AS response, masked_text AS masked_prompt, "
        f"{_ANSWER.format('masked_text')} AS masked_response, '{model}' AS model, "
        "'<PHONE_999>' AS hallucinated, 'regex' AS origin FROM masked",
    )


@query("private_enrich", _round_trip_sql(LEADS, "my-model"))
def run_private_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    def answer(sent: DataFrame) -> DataFrame:
        return sent.select(
            "mapping_id", F.expr(_ANSWER.format("masked_prompt")).alias("masked_response")
        )

    return _flat(
        private_enrich(
            leads(spark, sf_dir), "t", answer, ["id"], "__custom__", " my-model ", stage=stage
        )
    )


@query("private_enrich_column", _round_trip_sql(VISITS, "fixed"))
def run_private_enrich_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    def answer(masked: Column) -> Column:
        return F.concat(F.lit("re: "), masked, F.lit(" cc <PHONE_999>"))

    return _flat(private_enrich_column(visits(spark, sf_dir), "t", answer, ["id"], "fixed"))


@query(
    "build_messages",
    o.with_(
        o.masked("id", LEADS),
        "SELECT id, CASE WHEN segment = 'BUILDING' THEN '' ELSE concat('system:', 'mail ', "
        "segment, '@x.ru', ' | ') END || 'user:' || masked_text AS messages FROM masked",
    ),
)
def run_build_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The system text is sent as it is, even where it holds personal data."""
    system = F.when(F.col("segment") == "BUILDING", F.lit("")).otherwise(
        F.concat(F.lit("mail "), F.col("segment"), F.lit("@x.ru"))
    )
    masked = mask(leads(spark, sf_dir), "t", ["id"])
    messages = build_messages(F.col("masked.masked_text"), system)
    shown = F.transform(messages, lambda m: F.concat_ws(":", m["role"], m["content"]))
    return masked.select("id", F.array_join(shown, " | ").alias("messages"))


_COMPLETION = (
    "CASE conv_id % 4 WHEN 0 THEN '{{\"choices\":[]}}' WHEN 1 THEN NULL ELSE {json} END"
)


@query(
    "first_choice",
    "SELECT conv_id, turn, CASE WHEN conv_id % 4 < 2 THEN '' ELSE text END AS content "
    "FROM conversations",
)
def run_first_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    answer = (
        "to_json(named_struct('id', 'c', 'choices', array(named_struct('index', 0, 'message', "
        "named_struct('role', role, 'content', text), 'finish_reason', 'stop'))))"
    )
    turns = table(spark, sf_dir, "conversations")
    completion = F.expr(_COMPLETION.format(json=answer))
    return turns.select("conv_id", "turn", first_choice(completion).alias("content"))


_PICK = (
    "CASE c_custkey % 3 WHEN 0 THEN '__custom__' WHEN 1 THEN 'fixed' ELSE '' END"
)


@query(
    "resolve_model",
    f"SELECT c_custkey AS id, CASE {_PICK} WHEN '__custom__' THEN c_mktsegment ELSE {_PICK} END "
    "AS model FROM customer",
)
def run_resolve_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment")
    free = F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit("\n\t"))
    return df.select(
        F.col("c_custkey").alias("id"), resolve_model(F.expr(_PICK), free).alias("model")
    )
