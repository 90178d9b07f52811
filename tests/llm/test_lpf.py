"""Removal of later copies against a walk over all strings in plain Python."""

import hashlib
import random

import numpy as np
import pytest

from maskwright.llm import lpf
from maskwright.llm.lpf import previous_factors, remove_later_copies
from maskwright.sources import staging
from maskwright.sources.files import children
from maskwright.sources.staging import CLEANUP


def brute(docs, length):
    seen, out = set(), []
    order = sorted(range(len(docs)), key=lambda i: (docs[i][0] is not None, docs[i][0] or 0))
    rows = {}
    for i in order:
        data = (docs[i][1] or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - length + 1):
            piece = data[s : s + length]
            if piece in seen:
                gone[s : s + length] = b"\1" * length
            seen.add(piece)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        rows[i] = (docs[i][0], len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return sorted((rows[i] for i in rows), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def made(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdé ", k=rng.randrange(1, 9)))
    passages = [" ".join(word() for _ in range(rng.randrange(3, 40))) for _ in range(6)]
    docs = []
    for i in range(50):
        parts = [rng.choice(passages) if rng.random() < 0.5 else word() * rng.randrange(1, 6) for _ in range(5)]
        docs.append((i * 7 % 101, "".join(parts)))
    docs += [(200, None), (201, ""), (202, "z" * 3000), (203, "zy" * 900), (204, docs[3][1]), (None, docs[4][1])]
    docs += [(300 + i, passages[0] + str(i)) for i in range(30)]
    docs += [(400, "\x00" * 300), (401, "a\x00" * 200 + "\x00" * 200)]
    return docs


@pytest.mark.parametrize("seed,length,gram,hot", [(1, 32, 8, 4096), (2, 20, 16, 4096), (3, 32, 8, 2), (4, 100, 16, 4096)])
def test_against_brute_force(spark, seed, length, gram, hot):
    docs = made(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as doc", "2 as h").repartition(4)
    assert got(remove_later_copies(df, length=length, gram=gram, hot=hot, salts=3)) == brute(docs, length)


def test_documents(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert got(remove_later_copies(df)) == brute([(r.doc_id, r.text) for r in df.collect()], 100)


def test_repeated_rows_and_empty_table(spark):
    text = "some text that is long enough to be found again " * 2
    df = spark.createDataFrame([(1, text), (1, text)], "doc_id long, text string")
    assert [r.n_removed for r in remove_later_copies(df, length=60).collect()] == [0, 0]
    assert remove_later_copies(df.limit(0)).count() == 0
    rows = remove_later_copies(
        spark.createDataFrame([(1, text), (2, "x" + text)], "doc_id long, text string"), length=60, keep_text=True
    ).collect()
    assert {r.doc_id: bytes(r.kept) for r in rows} == {1: text.encode(), 2: b"x"}


@pytest.mark.parametrize("seed", range(5))
def test_previous_factors(seed):
    rng = np.random.default_rng(seed)
    data = rng.integers(97, 99, 80).astype(np.uint8)
    strings = np.lib.stride_tricks.sliding_window_view(data, 6)
    group = rng.integers(0, 2, len(strings))
    position = rng.permutation(len(strings))
    want = []
    for i in range(len(strings)):
        best = 0
        for j in range(len(strings)):
            if group[i] == group[j] and position[j] < position[i]:
                same = strings[i] == strings[j]
                best = max(best, 6 if same.all() else int(same.argmin()))
        want.append(best)
    assert previous_factors(strings, group, position).tolist() == want


def test_anchors_are_shuffled_once(spark, sf_dir):
    """The plan up to the segments, with the joins that come later: one exchange serves both readers."""
    docs = lpf.documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text")
    first = lpf.stage(lpf.identified(docs).groupBy("h", "h2").agg(lpf.F.min("doc").alias("doc")), "first")
    found = lpf.segments(lpf.compressed(docs), first, lpf.repeated(lpf.anchors(docs, 100, 16)), 100)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = [line.lstrip(" :+-") for line in plan.splitlines()]
    dealt = [line for line in lines if line.startswith("Exchange") and "REPARTITION_BY_COL" in line]
    assert len(dealt) == 1 and sum("ReusedExchange" in line for line in lines) == 1
    assert sum(line.startswith("MapInArrow run(doc_id") for line in lines) == 2


def test_steps_go_once_they_are_read(spark, monkeypatch, tmp_path):
    # A folder of its own: other runs may write to the shared one meanwhile.
    folder = str(tmp_path)
    monkeypatch.setattr(staging, "shared_folder", lambda spark: folder)
    freed = []
    stage = lpf.stage
    monkeypatch.setattr(lpf, "stage", lambda *a: freed.append(spark.conf.get(CLEANUP, None)) or stage(*a))
    text = "".join(chr(97 + i * i % 23) for i in range(300))
    df = spark.createDataFrame([(1, text), (2, "x" + text), (3, None)], "doc_id long, text string")
    found = {r.doc_id: r.n_removed for r in lpf.remove_later_copies(df).collect()}
    assert found[2] == 300 and found[3] == 0 and set(freed) == {"true"}
    written = children(spark, folder)
    left = {n.rsplit("-", 1)[0] for n in written}
    assert written and not left & {"places", "found-segments", "segments", "hot-anchors", "single-starts"}
