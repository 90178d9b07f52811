"""Sources, sinks, streams and the SQL surface."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskwright.functions.sql import register_functions, register_views
from maskwright.operators.audit import flag_split, row_audit
from maskwright.operators.detect import detect
from maskwright.operators.restore import restore_with_mapping
from maskwright.plans import oracle as o
from maskwright.plans.registry import query
from maskwright.plans.texts import CORPUS, LEAD, LEADS, corpus, leads, spread, table
from maskwright.sources.staging import new_path
from maskwright.sources.tables import read_csv, write_csv
from maskwright.sources.vault import read_vault, write_masked
from maskwright.streaming.audit_stream import audit_to_table, read_audit, stream_audit
from maskwright.streaming.mask_stream import mask_stream


def _read_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table as a stream of files."""
    path = f"{sf_dir}/{name}.parquet"
    # A stream reads a folder or a pattern; the pattern here matches one file.
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path + "*")


_CSV_ROW = (
    "concat('{\"id\":\"', id, '\",\"segment\":\"', segment, '\",\"t\":\"', t, '\"}')"
)


@query(
    "csv_source",
    o.with_(
        o.found("id", f"SELECT cast(id AS varchar) AS id, {_CSV_ROW} AS t FROM ({LEADS})"),
        "SELECT id, category, count(*) AS hits FROM hit GROUP BY id, category",
    ),
)
def run_csv_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows are written as CSV, read back as text columns, and audited as whole rows."""
    path = new_path(spark, "csv")
    write_csv(leads(spark, sf_dir), path)
    out = row_audit(read_csv(spark, path, "id string, segment string, t string"))
    return out.select("id", F.explode("pii.found_pii").alias("f")).select(
        "id", "f.category", F.col("f.count").cast("bigint").alias("hits")
    )


_PII_JSON = (
    "'{\"found_pii\":[' || string_agg('{\"category\":\"' || category || '\",\"count\":' || n || "
    "',\"samples\":[]}', ',' ORDER BY ord) || '],\"total_count\":' || cast(sum(n) AS bigint) || "
    "',\"source\":\"regex\"}'"
)


@query(
    "csv_sink",
    o.with_(
        o.found("src, id", CORPUS)
        + ", per AS (SELECT src, id, ord, category, count(*) AS n FROM hit "
        "GROUP BY src, id, ord, category)",
        f"SELECT src, id, t, {_PII_JSON} AS pii FROM per JOIN src USING (src, id) GROUP BY src, id, t",
    ),
)
def run_csv_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagged rows go to CSV with their whole texts, line breaks and all."""
    flagged, _ = flag_split(detect(corpus(spark, sf_dir), "t", include_samples=False, on_error="keep").drop("error"))
    path = new_path(spark, "flagged")
    write_csv(flagged, path, escaped=True)
    return read_csv(spark, path, "src string, id long, t string, pii string", escaped=True)


@query(
    "csv_documents",
    o.with_(
        o.found("id", "SELECT doc_id AS id, text AS t FROM documents"),
        "SELECT doc_id, text, lang, source, n_chars, coalesce(n, 0) AS hits, "
        "CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN '' ELSE ' \\n' || chr(13) || chr(10) END AS odd "
        "FROM documents LEFT JOIN (SELECT id, count(*) AS n FROM hit GROUP BY id) ON id = doc_id",
    ),
)
def run_csv_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as CSV and back, with nulls, empty texts, escapes and a nested column, many tasks each way."""
    odd = (
        F.when(F.col("doc_id") % 3 == 0, F.lit(None).cast("string"))
        .when(F.col("doc_id") % 3 == 1, F.lit(""))
        .otherwise(F.lit(" \\n\r\n"))
    )
    found = detect(table(spark, sf_dir, "documents").withColumn("odd", odd), on_error="keep").drop("error")
    path = new_path(spark, "documents")
    write_csv(found, path, escaped=True)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema.fields)
    back = read_csv(spark, path, schema, escaped=True)
    return back.select(
        "doc_id", "text", "lang", "source", "n_chars",
        F.coalesce(F.col("pii.total_count"), F.lit(0)).cast("bigint").alias("hits"), "odd",
    )


@query(
    "write_masked",
    o.with_(o.masked("id", LEADS), "SELECT id, masked_text, t AS restored_text FROM masked"),
)
def run_write_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masked table and vault from one scan, then restored from the two."""
    masked_path, vault_path = new_path(spark, "masked"), new_path(spark, "vault")
    write_masked(
        leads(spark, sf_dir), masked_path, vault_path, "t", ["id"], F.col("segment")
    )
    out = restore_with_mapping(
        spark.read.parquet(masked_path),
        read_vault(spark, vault_path),
        F.col("masked.masked_text"),
        F.col("masked.mapping_id"),
        F.col("segment"),
    )
    return out.select("id", "masked.masked_text", "restored.restored_text")


@query(
    "stream_mask",
    o.with_(o.masked("id", LEADS), "SELECT id, masked_text, t AS restored_text FROM masked"),
)
def run_stream_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of customers is masked into a table and a vault, which then restore each other."""
    customers = _read_stream(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    stream = spread(customers).selectExpr(
        "c_custkey AS id", "c_mktsegment AS segment", f"{LEAD} AS t"
    )
    masked_path, vault_path = new_path(spark, "masked"), new_path(spark, "vault")
    writer = mask_stream(
        stream, masked_path, vault_path, new_path(spark, "progress"), "t", ["id"],
        F.col("segment"),
    )
    writer.trigger(availableNow=True).start().awaitTermination()
    out = restore_with_mapping(
        spark.read.parquet(masked_path),
        read_vault(spark, vault_path),
        F.col("masked.masked_text"),
        F.col("masked.mapping_id"),
        F.col("segment"),
    )
    return out.select("id", "masked.masked_text", "restored.restored_text")


_TURN = "concat('mail c', cast(conv_id AS string), '@x.ru as ', role)"
_TURNS = f"SELECT conv_id AS id, turn, {_TURN} AS t FROM conversations"


@query(
    "stream_repeated",
    o.with_(
        o.masked("id, turn", _TURNS),
        "SELECT id, turn, masked_text, t AS restored_text, "
        "(SELECT count(DISTINCT t) FROM src) AS mappings FROM masked",
    ),
)
def run_stream_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of a conversation share key and text, within batches and across: as many rows come back."""
    arrivals = new_path(spark, "turns")
    turns = table(spark, sf_dir, "conversations").selectExpr("conv_id AS id", "turn", f"{_TURN} AS t")
    turns.repartition(4, "turn").write.parquet(arrivals)
    stream = spark.readStream.schema(turns.schema).option("maxFilesPerTrigger", 1).parquet(arrivals)
    masked_path, vault_path = new_path(spark, "masked"), new_path(spark, "vault")
    writer = mask_stream(
        stream, masked_path, vault_path, new_path(spark, "progress"), "t", ["id"], compact_every=2
    )
    writer.trigger(availableNow=True).start().awaitTermination()
    vault = read_vault(spark, vault_path)
    out = restore_with_mapping(
        spark.read.parquet(masked_path), vault, F.col("masked.masked_text"), F.col("masked.mapping_id")
    )
    return out.select(
        "id", "turn", "masked.masked_text", "restored.restored_text", F.lit(vault.count()).alias("mappings")
    )


_EVENT_TEXT = (
    "concat('user u', cast(user_id AS string), '@x.ru at 10.0.', cast(user_id % 300 AS string), "
    "'.1 did ', event_type, ' ', props)"
)
_EVENTS = f"SELECT event_id AS id, ts, {_EVENT_TEXT} AS t FROM events"
_HOURLY = (
    "SELECT date_trunc('hour', ts) AS window_start, "
    "date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, category, count(*) AS hits, "
    "count(DISTINCT id) AS rows_with_hits FROM hit JOIN src USING (id) GROUP BY ALL"
)


@query("window_audit", o.with_(o.found("id", _EVENTS), _HOURLY))
def run_window_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events", "ts", "user_id", "event_type", "props")
    return stream_audit(events, "ts", F.expr(_EVENT_TEXT), window="1 hour")


@query(
    "stream_audit",
    o.with_(
        o.found("id", _EVENTS),
        f"SELECT * FROM ({_HOURLY}) WHERE window_end <= "
        "(SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE FROM events)",
    ),
)
def run_stream_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows that the watermark has closed by the end of the stream."""
    counts = stream_audit(
        _read_stream(spark, sf_dir, "events"), "ts", F.expr(_EVENT_TEXT), window="1 hour"
    )
    path = new_path(spark, "windows")
    (
        counts.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", new_path(spark, "progress"))
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.schema(counts.schema).parquet(path)


_LATE = "FLOOR(event_id / 2) % 3 = 0"


@query(
    "stream_audit_late",
    o.with_(
        o.found("id", _EVENTS)
        + f", seen AS (SELECT event_id AS id, ts, {_LATE} AS second FROM events)"
        + ", mark AS (SELECT max(ts) FILTER (NOT second) - INTERVAL 10 MINUTE AS first_mark, "
        "max(ts) - INTERVAL 10 MINUTE AS last_mark FROM seen)"
        + ", timed AS (SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR "
        "AS window_end, category, id, second FROM hit JOIN seen USING (id))",
        "SELECT window_start, window_end, category, count(*) FILTER (NOT late) AS hits, "
        "count(DISTINCT id) FILTER (NOT late) AS rows_with_hits, count(*) FILTER (late) AS late_hits, "
        "count(DISTINCT id) FILTER (late) AS late_rows, window_end <= max(last_mark) AS closed "
        "FROM (SELECT *, second AND window_end <= first_mark AS late FROM timed, mark) GROUP BY ALL",
    ).replace("GROUP BY ALL", "GROUP BY window_start, window_end, category"),
)
def run_stream_audit_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the events arrives after the rest: each is counted, in time or late, in its window."""
    arrivals, path, progress = (new_path(spark, n) for n in ("arrivals", "audit", "progress"))
    events = table(spark, sf_dir, "events")
    for late in (False, True):
        events.where(F.expr(_LATE) == late).write.mode("append").parquet(arrivals)
        stream = spark.readStream.schema(events.schema).parquet(arrivals)
        writer = audit_to_table(stream, path, progress, "ts", F.expr(_EVENT_TEXT), window="1 hour")
        writer.trigger(availableNow=True).start().awaitTermination()
    return read_audit(spark, path)


@query(
    "sql_functions",
    o.with_(
        o.found("id", LEADS, ["EMAIL", "INN", "PHONE"]),
        "SELECT src.id, coalesce(max(raw) FILTER (category = 'EMAIL'), '') AS mail, "
        "coalesce(max(raw) FILTER (category = 'PHONE'), '') AS phone, "
        "count(*) FILTER (category = 'INN') AS inns, "
        f"{o.inn_valid('cast(7700000000 + src.id AS varchar)')} AS valid "
        "FROM src LEFT JOIN hit USING (id) GROUP BY src.id",
    ),
)
def run_sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_functions(spark)
    return leads(spark, sf_dir).selectExpr(
        "id",
        "array_join(pii_email(t), ' ') AS mail",
        "array_join(pii_phone(t), ' ') AS phone",
        "cast(size(pii_inn(t)) AS bigint) AS inns",
        "inn_valid(cast(7700000000 + id AS string)) AS valid",
    )


@query(
    "sql_table_function",
    o.with_(
        o.found("src, id", CORPUS),
        "SELECT src, id, ord, category, row_number() OVER (PARTITION BY src, id, ord ORDER BY start) AS nth, raw "
        "FROM hit",
    ),
)
def run_sql_table_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One half of the corpus through the table function, the other through the function of arrays."""
    register_functions(spark)
    corpus(spark, sf_dir).createOrReplaceTempView("corpus_texts")
    # Spark tests a generator's column for its size below all that makes it, and so matches twice; an
    # expression it does not test.
    return spark.sql(
        "SELECT c.src, c.id, h.ord, h.category, cast(h.nth AS bigint) AS nth, h.raw "
        "FROM (SELECT * FROM corpus_texts WHERE src <> 'visits') c, LATERAL pii_hits(c.t) h UNION ALL "
        "SELECT src, id, ord, category, cast(nth AS bigint), raw FROM (SELECT src, id, inline(filter(f, h -> true)) "
        "FROM (SELECT src, id, pii_found(t) AS f FROM corpus_texts WHERE src = 'visits'))"
    )


@query(
    "sql_views",
    o.with_(
        o.spans("id", LEADS),
        "SELECT category, count(*) AS masked, count(DISTINCT id) AS texts FROM span "
        "GROUP BY category",
    ),
)
def run_sql_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_views(leads(spark, sf_dir), "leads", "t", ["id"])
    return spark.sql(
        "SELECT category, count(*) AS masked, count(DISTINCT mapping_id) AS texts "
        "FROM leads_entities GROUP BY category"
    )
