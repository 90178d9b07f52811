"""CSV in one line per row, routed writes, and bucketed tables."""

import random

import pytest
from pyspark.sql import functions as F

from maskwright import detect
from maskwright.operators.mask import vault_rows
from maskwright.operators.restore import restore_with_mapping
from maskwright.plans.texts import leads
from maskwright.sources.bucketed import orphan_rows, restore_tables, unused_rows, write_masked_tables
from maskwright.sources.tables import read_csv, write_csv, write_routed

SCHEMA = (
    "id long, t string, `odd, name` string, d double, b binary, x decimal(9,2), at timestamp, day date, ok boolean, "
    "s struct<a:string,n:array<int>>, m map<string,string>"
)


def _rows(rng):
    bits = ["a", "\\", "\n", "\r", "\r\n", '"', '""', ",", "\\n", "\\N", " ", "\t", "é😀", "#", "'", "", "\\s"]

    def text():
        return rng.choice([None, "", "\\N", "".join(rng.choices(bits, k=rng.randint(0, 12)))])

    for i in range(600):
        yield (
            i, text(), text(), rng.choice([None, 1e300, 0.1, -0.0]), rng.choice([None, b"\x00\n\xff", b""]), None,
            None, None, rng.choice([None, True]), rng.choice([None, (text(), [1, 2]), (None, None)]),
            rng.choice([None, {"k\n": "v\\"}, {}]),
        )


def test_escaped_csv_gives_every_value_back(spark, tmp_path):
    rows = list(_rows(random.Random(2)))
    df = spark.createDataFrame(rows, SCHEMA).withColumns(
        {
            "x": F.expr("cast(id / 8 AS decimal(9,2))"),
            "at": F.expr("timestamp_micros(id * 86399999999)"),
            "day": F.expr("date_add(DATE'1969-12-30', cast(id AS int))"),
        }
    )
    path = str(tmp_path / "csv")
    write_csv(df.repartition(3), path, escaped=True)
    back = read_csv(spark, path, SCHEMA, escaped=True)
    assert back.schema.simpleString() == df.schema.simpleString()
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_escaped_csv_is_read_in_many_tasks(spark, tmp_path):
    path = str(tmp_path / "csv")
    df = spark.range(20_000).select("id", F.concat(F.lit("line\nline\n"), "id").alias("t")).coalesce(1)
    write_csv(df, path, escaped=True)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50k")
    try:
        back = read_csv(spark, path, "id long, t string", escaped=True)
        assert back.rdd.getNumPartitions() > 5
        assert back.where(F.col("t") == F.concat(F.lit("line\nline\n"), "id")).count() == 20_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    with pytest.raises(ValueError):
        read_csv(spark, path, "id long", multiline=True, escaped=True)


def test_routed_write_reads_its_source_once(spark, sf_dir, tmp_path):
    found = detect(leads(spark, sf_dir).withColumn("t", F.when(F.col("id") % 3 > 0, F.col("t")).otherwise("no")), "t")
    route = F.when(F.col("pii.total_count") > 0, "flagged").otherwise("rest")
    ways = write_routed(found, str(tmp_path / "r"), route)
    assert ways == {"flagged": 100, "rest": 50}
    rest = spark.read.parquet(str(tmp_path / "r" / "route=rest"))
    assert rest.where("pii.total_count > 0").count() == 0 and "t" in rest.columns


@pytest.fixture
def tables(spark, sf_dir, tmp_path):
    names = ["bucketed_masked", "bucketed_vault"]
    df = leads(spark, sf_dir)
    paths = (str(tmp_path / "m"), str(tmp_path / "v"))
    write_masked_tables(
        df.union(df), *names, "t", ["id"], 4, F.col("segment"), paths=paths, stage_path=str(tmp_path / "stage")
    )
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark.table(names[0]), spark.table(names[1])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    for name in names:
        spark.sql(f"DROP TABLE {name}")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_tables_are_joined_in_place(spark, tables, tmp_path):
    masked, vault = tables
    assert not (tmp_path / "stage").exists()
    for df in (restore_tables(masked, vault), orphan_rows(masked, vault), unused_rows(masked, vault)):
        assert "Exchange" not in _plan(df)
    assert orphan_rows(masked, vault).count() == 0 and unused_rows(masked, vault).count() == 0
    back = restore_tables(masked, vault).select("id", "restored.restored_text", "workspace_id")
    want = leads(spark, "/root/testdata/sf0.001").select("id", "t", "segment")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, want.union(want).collect()))
    assert restore_tables(masked, vault).where("size(restored.hallucinated) > 0").count() == 0


def test_other_layouts_are_shuffled_and_give_the_same(spark, tables, sf_dir):
    masked, vault = tables
    other = vault_rows(leads(spark, sf_dir), "t", ["id"], F.col("segment"))
    assert "Exchange" in _plan(restore_tables(masked, other))
    columns = ["id", "restored.restored_text"]
    got = restore_tables(masked, other).select(*columns)
    plain = restore_with_mapping(
        masked, vault, F.col("masked.masked_text"), "mapping_id", F.col("workspace_id")
    ).select(*columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))


def test_key_columns_are_not_overwritten(spark):
    df = spark.createDataFrame([(1, "x", "w")], "id int, t string, Workspace_Id string")
    with pytest.raises(ValueError):
        write_masked_tables(df, "a", "b", "t", ["id"], 2)
