"""Streams: the same rows as in batch, and nothing twice after a replay."""

import shutil

import pytest
from pyspark.sql import functions as F

from maskwright import detect, mask
from maskwright.operators.audit import duplicate_mappings
from maskwright.operators.restore import restore_with_mapping
from maskwright.sources.files import children
from maskwright.sources.vault import compact_vault, read_vault
from maskwright.streaming.audit_stream import audit_to_table, read_audit, stream_audit
from maskwright.streaming.mask_stream import mask_stream


@pytest.fixture
def arrivals(spark, sf_dir, tmp_path):
    """Customers' leads arriving in four files."""
    from maskwright.plans.texts import leads

    folder = str(tmp_path / "in")
    leads(spark, sf_dir).repartition(4).write.parquet(folder)
    return folder


def _stream(spark, folder):
    schema = spark.read.parquet(folder).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def _run(writer):
    writer.trigger(availableNow=True).start().awaitTermination()


def test_stream_gives_what_batch_gives(spark, arrivals, tmp_path):
    out, vault = str(tmp_path / "masked"), str(tmp_path / "vault")
    _run(mask_stream(_stream(spark, arrivals), out, vault, str(tmp_path / "c"), "t", ["id"]))
    got = spark.read.parquet(out)
    assert got.select("batch_id").distinct().count() == 4
    assert "t" not in got.columns
    want = mask(spark.read.parquet(arrivals), "t", ["id"]).select("id", "masked")
    assert sorted(map(str, got.select("id", "masked").collect())) == sorted(
        map(str, want.collect())
    )
    assert duplicate_mappings(read_vault(spark, vault)).count() == 0


def test_replay_leaves_no_second_copy(spark, arrivals, tmp_path):
    """The progress is lost after the tables were written, so every batch runs again."""
    out, vault, progress = (str(tmp_path / n) for n in ("masked", "vault", "progress"))

    def once():
        _run(mask_stream(_stream(spark, arrivals), out, vault, progress, "t", ["id"]))
        return (
            spark.read.parquet(out).count(),
            read_vault(spark, vault).count(),
            duplicate_mappings(read_vault(spark, vault)).count(),
        )

    first = once()
    shutil.rmtree(progress)
    assert once() == first and first[2] == 0


def test_row_operators_work_on_streams_as_they_are(spark, arrivals):
    found = detect(_stream(spark, arrivals), "t")
    query = (
        found.select("id", "pii.total_count")
        .writeStream.format("memory").queryName("found").outputMode("append")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    want = detect(spark.read.parquet(arrivals), "t").agg(F.sum("pii.total_count")).first()[0]
    assert spark.table("found").agg(F.sum("total_count")).first()[0] == want


REPEATED = [(i % 5, f"mail u{i % 5}@x.ru") for i in range(60)] + [(9, "none"), (9, "none")]


@pytest.fixture
def repeated(spark, tmp_path):
    """Rows that share key and text, within files and across them."""
    folder = str(tmp_path / "in")
    spark.createDataFrame(REPEATED, "id int, t string").repartition(6).write.parquet(folder)
    return folder


@pytest.mark.parametrize("every", [None, 1, 2, 4])
def test_repeated_rows_come_back_as_often_as_they_came(spark, repeated, tmp_path, every):
    out, vault, progress = (str(tmp_path / n) for n in ("masked", "vault", "progress"))

    def once():
        stream = _stream(spark, repeated)
        _run(mask_stream(stream, out, vault, progress, "t", ["id"], compact_every=every))
        back = restore_with_mapping(
            spark.read.parquet(out), read_vault(spark, vault), "masked.masked_text", "masked.mapping_id"
        )
        return sorted((r.id, r.restored.restored_text) for r in back.collect())

    assert once() == sorted(REPEATED)
    assert read_vault(spark, vault).count() == 5
    # All batches run again: merged ones are not read twice.
    shutil.rmtree(progress)
    assert once() == sorted(REPEATED)
    assert read_vault(spark, vault, "default").count() == 5
    compact_vault(spark, vault)
    compact_vault(spark, vault)
    assert len(children(spark, vault)) == 1 and read_vault(spark, vault).count() == 5
    assert once() == sorted(REPEATED)


def test_broken_off_merge_does_not_count(spark, repeated, tmp_path):
    out, vault = str(tmp_path / "masked"), str(tmp_path / "vault")
    _run(mask_stream(_stream(spark, repeated), out, vault, str(tmp_path / "c"), "t", ["id"]))
    before = sorted(map(str, read_vault(spark, vault).collect()))
    # A merge that wrote some files and ended: no mark of success.
    read_vault(spark, vault).limit(1).write.partitionBy("workspace_id").parquet(f"{vault}/merged_upto=3")
    (tmp_path / "vault" / "merged_upto=3" / "_SUCCESS").unlink()
    assert sorted(map(str, read_vault(spark, vault).collect())) == before
    compact_vault(spark, vault)
    assert sorted(map(str, read_vault(spark, vault).collect())) == before


def test_vault_of_nothing(spark, tmp_path):
    folder = str(tmp_path / "in")
    spark.createDataFrame([(1, "none")], "id int, t string").write.parquet(folder)
    out, vault = str(tmp_path / "masked"), str(tmp_path / "vault")
    _run(mask_stream(_stream(spark, folder), out, vault, str(tmp_path / "c"), "t", ["id"], compact_every=1))
    assert read_vault(spark, vault).count() == 0


EVENTS = [
    [("10:05", "a@x.ru"), ("10:20", "a@x.ru b@x.ru"), ("11:40", "none")],
    [("10:30", "late@x.ru 10.0.0.1"), ("11:10", "in@x.ru"), ("12:50", "c@x.ru")],
    [("10:01", "late@x.ru"), ("11:59", "late@x.ru"), ("12:01", "in@x.ru")],
    [("09:00", "late@x.ru")],
]


def test_late_rows_are_counted_per_window(spark, tmp_path):
    """Watermarks are 11:30, 12:40 and 12:40 at the second, third and fourth batch."""
    folder, path, progress = (str(tmp_path / n) for n in ("in", "audit", "progress"))
    plain = str(tmp_path / "plain")

    def arrive(upto):
        for rows_ in EVENTS[upto - 1 : upto]:
            timed = [(f"2026-01-01 {t}:00", x) for t, x in rows_]
            df = spark.createDataFrame(timed, "at string, text string").selectExpr("cast(at AS timestamp) at", "text")
            df.coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema("at timestamp, text string").parquet(folder)
        _run(audit_to_table(stream, path, progress, "at", window="1 hour"))
        counts = stream_audit(stream, "at", window="1 hour")
        _run(
            counts.writeStream.format("parquet").outputMode("append").option("path", plain)
            .option("checkpointLocation", str(tmp_path / "plain-progress"))
        )

    for upto in range(1, 5):
        arrive(upto)
    read = lambda: {
        (r.window_start.hour, r.category): (r.hits, r.rows_with_hits, r.late_hits, r.late_rows, r.closed)
        for r in read_audit(spark, path).collect()
    }
    want = {
        (9, "EMAIL"): (0, 0, 1, 1, True),
        (10, "EMAIL"): (3, 2, 2, 2, True),
        (10, "IP"): (0, 0, 1, 1, True),
        (11, "EMAIL"): (1, 1, 1, 1, True),
        (12, "EMAIL"): (2, 2, 0, 0, False),
    }
    assert read() == want
    # Closed windows have what Spark's own watermark lets through.
    own = spark.read.parquet(plain).collect()
    assert {(r.window_start.hour, r.category): r.hits for r in own} == {
        k: v[0] for k, v in want.items() if v[4] and v[0]
    }
