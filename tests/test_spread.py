"""Small keys of one row group are dealt out to many tasks before long texts are made of them."""

import pytest

from maskwright.functions.sql import register_functions
from maskwright.plans import QUERIES
from maskwright.plans.texts import leads, visits


@pytest.fixture(scope="module")
def keys(spark, tmp_path_factory):
    """Tables of one row group each; most keys repeat or are null."""
    path = tmp_path_factory.mktemp("keys")
    key = "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN 7 ELSE id END"
    spark.range(0, 3000, 1, 1).selectExpr(
        f"{key} AS c_custkey", "concat('N', id) AS c_name", "'BUILDING' AS c_mktsegment"
    ).write.parquet(str(path / "customer.parquet"))
    spark.range(0, 3000, 1, 1).selectExpr(f"{key} AS o_orderkey", "1L AS o_custkey").write.parquet(
        str(path / "orders.parquet")
    )
    return str(path)


@pytest.mark.parametrize("texts", [leads, visits])
def test_rows_of_one_row_group_go_to_many_tasks(spark, keys, texts):
    df = texts(spark, keys)
    sizes = [r[1] for r in df.selectExpr("spark_partition_id() AS p").groupBy("p").count().collect()]
    assert sum(sizes) == 3000 and len(sizes) >= 32 and max(sizes) < 3000 / 8


def test_a_batch_of_a_stream_is_masked_by_many_tasks(spark, tmp_path):
    path = str(tmp_path / "customer.parquet")
    spark.range(0, 300, 1, 1).selectExpr(
        "id AS c_custkey", "concat('N', id) AS c_name", "'BUILDING' AS c_mktsegment"
    ).coalesce(1).write.parquet(path)
    out = QUERIES["stream_mask"](spark, str(tmp_path))
    written = {f for f in out.inputFiles() if "/masked-" in f}
    assert len(written) >= 8 and out.count() == 300


def test_the_table_function_is_no_join(spark):
    register_functions(spark)
    spark.sql(
        "SELECT * FROM VALUES (1, 'a@x.ru, b@x.ru'), (2, 'a@x.ru, b@x.ru'), (3, NULL), (4, ''), (5, '10.0.0.1') "
        "AS v(id, t)"
    ).createOrReplaceTempView("table_function_texts")
    df = spark.sql("SELECT v.id, h.* FROM table_function_texts v, LATERAL pii_hits(v.t) h")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan
    mails = [(0, "EMAIL", 1, "a@x.ru"), (0, "EMAIL", 2, "b@x.ru")]
    assert sorted(map(tuple, df.collect())) == sorted(
        [(i, *mail) for i in (1, 2) for mail in mails] + [(5, 5, "IP", 1, "10.0.0.1")]
    )


def test_on_error_fail_masks_all_good_rows(spark, tmp_path):
    path = str(tmp_path / "customer.parquet")
    spark.range(0, 20, 1, 1).selectExpr("id AS c_custkey", "concat('N', id) AS c_name").write.parquet(path)
    rows = QUERIES["on_error_fail"](spark, str(tmp_path)).collect()
    good = {r.id: r.masked_text for r in rows if r.id is not None}
    assert set(good) == {i for i in range(20) if i % 5 > 1}
    assert all("<EMAIL_001>" in text for text in good.values())
    assert sorted((r.kind, r.names_a_bad_row) for r in rows if r.id is None) == [(0, True), (1, True)]


def test_the_table_function_query_matches_each_text_once(spark, sf_dir):
    plan = QUERIES["sql_table_function"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("order , cast(") == 1 and "size(" not in plan
