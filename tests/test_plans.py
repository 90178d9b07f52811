"""What the plans look like: what is pushed down, what is shuffled, what is split."""

import re

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from maskwright import audit_log, dataset_audit, detect, mask, restore_with_mapping, vault_rows
from maskwright.functions.sql import definitions
from maskwright.plans import QUERIES
from maskwright.sources.vault import read_vault, write_vault


# These write tables before they return, so their own plan is that of a reader.
WRITING = {"write_masked", "stream_mask", "stream_audit"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def test_masking_moves_nothing_and_stays_in_the_jvm(documents):
    plan = plan_of(mask(documents, "text", ["doc_id"]))
    assert "Exchange" not in plan and "Python" not in plan and "ArrowEval" not in plan


def test_only_the_needed_columns_are_read(documents):
    plan = plan_of(mask(documents, "text", ["doc_id"]).select("doc_id", "masked.masked_text"))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_filters_on_other_columns_reach_the_scan(documents):
    plan = plan_of(mask(documents, "text", ["doc_id"]).where("lang = 'en'"))
    assert "EqualTo(lang,en)" in plan


def test_filters_on_the_output_do_not_repeat_the_matching(documents):
    """Each expression occurs once, whatever is filtered or exploded afterwards."""
    masked = mask(documents, "text", ["doc_id"]).where("size(masked.entities) > 0")
    for df in (
        masked.select("doc_id", F.inline("masked.entities")),
        detect(documents).where("pii.total_count > 0"),
    ):
        plan = plan_of(df)
        assert plan.count("regexp_extract_all(__mw_in_around_at") == 1


def test_unwanted_categories_are_not_in_the_plan(documents):
    plan = plan_of(detect(documents, categories=["EMAIL"]))
    assert plan.count("regexp_extract_all") == 1 and "RLIKE" not in plan


def test_dataset_audit_shuffles_partial_sums_only(documents):
    plan = plan_of(dataset_audit(documents, ["lang"], "text"))
    assert plan.count("Exchange") == 1 and plan.count("HashAggregate") == 2
    shuffled = plan[plan.index("Exchange"):]
    assert "partial_sum" in shuffled


def test_cube_copies_groups_not_rows(documents):
    plan = plan_of(dataset_audit(documents, ["lang", "source"], "text", grouping="cube"))
    assert "Exchange hashpartitioning(lang" in plan[plan.index("Expand"):]


def test_restoring_reads_two_fields_of_the_vault(spark, documents, tmp_path):
    path = str(tmp_path / "vault")
    write_vault(vault_rows(documents, "text", ["doc_id"]), path)
    masked = documents.selectExpr("doc_id", "text", "cast(doc_id AS string) AS mapping_id")
    plan = plan_of(restore_with_mapping(masked, read_vault(spark, path)))
    assert "entities:array<struct<placeholder:string,original:string>>" in plan


def test_audit_log_of_a_vault_is_not_shuffled(documents):
    assert "Exchange" not in plan_of(audit_log(vault_rows(documents, "text", ["doc_id"])))


def test_workspace_prunes_the_vaults_partitions(spark, documents, tmp_path):
    path = str(tmp_path / "vault")
    write_vault(vault_rows(documents, "text", ["doc_id"], F.col("lang")), path)
    one = read_vault(spark, path, "en")
    assert re.search(r"PartitionFilters: \[.*workspace_id#\d+ = en", plan_of(one))
    assert {r[0] for r in one.select("workspace_id").distinct().collect()} == {"en"}
    assert read_vault(spark, path).count() > one.count()


def test_no_query_deals_rows_out_by_size(spark, sf_dir):
    """Rows go to another task by key alone, whatever the size of the input."""
    for name, run in sorted(QUERIES.items()):
        if name not in WRITING:
            assert "RoundRobin" not in plan_of(run(spark, sf_dir)), name


@pytest.mark.parametrize("name", ["flag_split", "private_enrich", "duplicate_mappings", "csv_sink"])
def test_sources_are_read_once_for_several_outputs(spark, sf_dir, name, monkeypatch):
    """Of a query and all that it writes on its way no plan reads a given table twice."""
    plans = []

    def noted(save):
        def run(writer, *args, **options):
            plans.append(plan_of(writer._df))
            return save(writer, *args, **options)

        return run

    for kind in ("parquet", "csv"):
        monkeypatch.setattr(DataFrameWriter, kind, noted(getattr(DataFrameWriter, kind)))
    plans.append(plan_of(QUERIES[name](spark, sf_dir)))
    tables = re.findall(rf"{re.escape(sf_dir)}/(\w+)\.parquet", "".join(plans))
    # The corpus has five tables, read by one write; the others read customers alone.
    assert len(tables) == len(set(tables)) and len(tables) in (1, 5), tables


def test_checksums_bind_their_digits(spark):
    for body in definitions().values():
        assert body.count("regexp_replace(") <= 1


def test_a_mapping_shared_by_a_third_of_all_rows_is_split(spark, tmp_path):
    """With many rows on one mapping id the join is run as a skew join."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        spark.range(0, 30000, 1, 8).selectExpr(
            "id", "IF(id % 3 = 0, 'hot', concat('m', id % 1000)) AS mapping_id",
            "concat('to <NAME_001> ', sha2(cast(id AS string), 512)) AS text",
        ).write.parquet(str(tmp_path / "masked"))
        spark.range(0, 1001).selectExpr(
            "'default' AS workspace_id",
            "IF(id = 1000, 'hot', concat('m', id)) AS mapping_id",
            "array(named_struct('category', 'NAME', 'placeholder', '<NAME_001>', 'original', "
            "concat('n', id), 'start', 0, 'end', 2)) AS entities",
        ).write.parquet(str(tmp_path / "vault"))
        out = restore_with_mapping(
            spark.read.parquet(str(tmp_path / "masked")), spark.read.parquet(str(tmp_path / "vault"))
        )
        # Rows are collected through this very frame, so that its final plan can be read.
        got = out.select("id", "mapping_id", "restored.restored_text")
        rows = got.collect()
        assert "SortMergeJoin(skew=true)" in plan_of(got)
        assert len(rows) == 30000
        for r in rows:
            name = "n1000" if r.mapping_id == "hot" else "n" + r.mapping_id[1:]
            assert r.restored_text.startswith(f"to {name} ")
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_result_does_not_depend_on_partitions(documents):
    def bag(df):
        return sorted(
            (r.doc_id, r.masked.masked_text, r.masked.mapping_id)
            for r in mask(df, "text", ["doc_id"]).collect()
        )

    assert bag(documents.coalesce(1)) == bag(documents.repartition(8))
