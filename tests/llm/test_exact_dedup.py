"""Exact deduplication against plain Python, with strong and with colliding digests."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from maskwright.llm.common import fold, lower_ascii
from maskwright.llm.exact_dedup import deduplicated, exact_dedup, sha256

DOCS = [
    (1, "Abc"), (2, "aBC"), (3, None), (4, ""), (5, "É"), (6, "é"), (7, "x" * 100_000), (8, "X" * 100_000),
    (9, "abc "), (2, "abc"), (2, "abc"), (None, "abc"), (None, "lone"), (None, "lone"),
] + [(100 + i, "hot") for i in range(300)]


def expected(docs):
    groups = defaultdict(list)
    for d, t in docs:
        groups[fold(t or "")].append(d)
    out = []
    for d, t in docs:
        norm = fold(t or "")
        keep = max((x for x in groups[norm] if x is not None), default=None)
        out.append((d, keep, len(groups[norm]), d == keep, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("digest", [sha256, lambda t: F.pmod(F.crc32(t), F.lit(3))])
def test_documents(spark, digest):
    df = spark.createDataFrame(DOCS, "doc_id long, text string").selectExpr(
        "*", "'q' as digest", "0 as keep_id", "1 as norm", "2 as id"
    ).repartition(5)
    got = sorted((tuple(r) for r in exact_dedup(df, digest=digest).collect()), key=repr)
    assert got == expected(DOCS)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup(df).count() == 0
    assert deduplicated(df).count() == 0


def test_deduplicated_keeps_columns_and_one_row_of_each_text(spark):
    df = spark.createDataFrame(DOCS, "doc_id long, text string").withColumn("norm", F.lit(7))
    rows = deduplicated(df).collect()
    assert deduplicated(df).columns == ["doc_id", "text", "norm"]
    assert len(rows) == len({fold(t or "") for _, t in DOCS})
    best = {(r[1], r[4]) for r in expected(DOCS)}
    assert {(r.doc_id, hashlib.sha256(fold(r.text or "").encode()).hexdigest()) for r in rows} == best


def test_lower_ascii(spark):
    texts = ["ABCxyzÀÉİΣ", "AZ@[`{", "", "ǅA"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(lower_ascii(F.col("t"))).collect()] == [fold(t) for t in texts]
