"""Named queries of this subpackage, each over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from maskwright.llm import sql
from maskwright.llm.automata import remove_repeated_passages
from maskwright.llm.common import table
from maskwright.llm.decontaminate import decontaminate
from maskwright.llm.exact_dedup import exact_dedup
from maskwright.llm.filter_audit import filter_audit
from maskwright.llm.jaccard_join import jaccard_join
from maskwright.llm.langid import identify
from maskwright.llm.lm import score
from maskwright.llm.lpf import remove_later_copies
from maskwright.llm.packing import pack
from maskwright.llm.pii import find_personal_data
from maskwright.llm.role_repair import repair_damaged
from maskwright.llm.token_counts import count_edited, redactions
from maskwright.llm.warc import warc_round_trip

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

# The edits that token counts follow: addresses and long numbers are masked.
EDITED = (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+|[0-9][0-9 .()-]{6,}[0-9]", "<MASKED>")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return count_edited(documents, RANKS, public_tokenizers.PATTERN, redactions(*EDITED))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_later_copies(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents")).drop("spans")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), TOKENIZER)


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("longest_words", "matches")


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), TOKENIZER)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_round_trip(table(spark, sf_dir, "pages"))


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_passages(table(spark, sf_dir, "documents"))


def op12_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_damaged(table(spark, sf_dir, "conversations"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_pii": op5_pii,
    "op6_decontaminate": op6_decontaminate,
    "op7_lm_score": op7_lm_score,
    "op8_warc": op8_warc,
    "op9_language_id": op9_language_id,
    "op10_packing": op10_packing,
    "op11_substring_dedup": op11_substring_dedup,
    "op12_role_repair": op12_role_repair,
    "op13_filter_audit": op13_filter_audit,
}

ORACLES: dict[str, str] = {
    "op3_exact_dedup": sql.EXACT_DEDUP,
    "op6_decontaminate": sql.DECONTAMINATE,
    "op8_warc": sql.WARC,
    "op12_role_repair": sql.ROLE_REPAIR,
    "op13_filter_audit": sql.FILTER_AUDIT,
}
