"""Rows without a text among the given tables: they count as read and have no hits, as in the SQL."""

import duckdb
import pytest

from maskwright.plans import ORACLES, QUERIES
from tests.compare import differences

DOCUMENTS = """
    SELECT * FROM (VALUES
      (1, 'mail a@x.ru, card 4111 1111 1111 1111', 'en', 'web', 37), (2, NULL, 'en', 'web', NULL),
      (3, '', 'de', 'web', 0), (4, 'nothing', 'de', 'book', 7), (5, NULL, NULL, NULL, NULL),
      (6, '10.0.0.1 and b@x.ru, c@x.ru', 'en', 'book', 27)
    ) v(doc_id, text, lang, source, n_chars)
"""
TABLES = {
    "documents": f"SELECT * REPLACE (cast(doc_id AS bigint) AS doc_id, cast(n_chars AS bigint) AS n_chars) FROM ({DOCUMENTS})",
    "labels": "SELECT cast(i AS bigint) AS doc_id, 1 AS quality, 0 AS toxic FROM range(1, 4) t(i)",
    "customer": "SELECT cast(i AS bigint) AS c_custkey, CASE WHEN i <> 2 THEN 'N' || i END AS c_name, "
    "'BUILDING' AS c_mktsegment FROM range(1, 4) t(i)",
    "orders": "SELECT cast(i AS bigint) AS o_orderkey, cast(CASE WHEN i <> 2 THEN i END AS bigint) AS o_custkey "
    "FROM range(1, 4) t(i)",
    "pages": "SELECT cast(i AS bigint) AS page_id, 'https://x.ru/' || i AS url, CASE i WHEN 1 THEN 'd@x.ru' WHEN 2 "
    "THEN '' END AS html FROM range(1, 4) t(i)",
    "conversations": "SELECT cast(i AS bigint) AS conv_id, cast(1 AS bigint) AS turn, 'user' AS role, "
    "CASE i WHEN 1 THEN 'e@x.ru' WHEN 2 THEN '' END AS text FROM range(1, 4) t(i)",
}
OVER_DOCUMENTS = """
    csv_documents dataset_audit dataset_audit_all_labels dataset_audit_cube dataset_audit_labels
    dataset_audit_rollup detect_documents detect_documents_all mask_documents
""".split()
OVER_CORPUS = """
    category_filter csv_sink detect detect_counts detect_samples flag_split hallucinated hit_card hit_date hit_email
    hit_inn hit_ip hit_phone hit_snils hit_url hits_all mapping_id mask mask_entities mask_text number_placeholders
    order_hits policy_source public_entities resolve_overlaps restore restore_text sql_table_function suppress_samples
""".split()


@pytest.fixture(scope="module")
def gaps(tmp_path_factory):
    path, con = tmp_path_factory.mktemp("gaps"), duckdb.connect()
    for name, sql in TABLES.items():
        con.execute(f"COPY ({sql}) TO '{path}/{name}.parquet'")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}/{name}.parquet'")
    return str(path), con


@pytest.mark.parametrize("name", OVER_DOCUMENTS + OVER_CORPUS)
def test_rows_without_a_text_do_not_end_the_run(spark, gaps, name):
    path, con = gaps
    assert differences(QUERIES[name](spark, path), con, ORACLES[name]) is None
