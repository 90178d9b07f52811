"""The filter audit against plain Python over every order."""

import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from maskwright.llm.filter_audit import filter_audit, prefixes

LONG = " ".join(f"word{i}" for i in range(60))
DOCS = [
    (1, LONG, "a"), (2, LONG, "a"), (3, LONG, "b"), (3, LONG, "b"), (None, LONG, "b"), (4, None, None),
    (5, "", ""), (6, "A B C", "a"), (7, "the " * 70, "b"), (8, LONG + " #", "a"), (9, LONG.upper(), "a"),
    (10, "x\u00a0y " * 200_000, "b"), (11, "A" * 50 + "$ \v\f" * 60, "a"), (7, "other", "b"),
] + [(100 + i, "hot text", "hot") for i in range(300)]
LABELS = [(1, 1, 0), (2, 1, 1), (3, None, 1), (7, 0, 1), (7, 1, 0), (500, 1, 1), (None, 1, 1), (110, 1, 1)]


def failures(docs):
    least = {}
    for d, t, _ in docs:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    for d, t, _ in docs:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        yield {
            c for c, failed in zip("ABCDE", (
                len(words) < 50, 100 * len(set(words)) < 65 * len(words),
                100 * len(re.findall("[A-Z]", t)) > 5 * len(t), bool(re.search("[#$%&*|]", t)),
                d is not None and d > least[t],
            )) if failed
        }


def expected(docs, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    out, removals = {}, {}
    fails = list(failures(docs))
    for part in {p or "" for _, _, p in docs}:
        mine = [(d, f) for (d, _, p), f in zip(docs, fails) if (p or "") == part]
        for order in permutations("ABCDE"):
            for step, letter in enumerate(order):
                before = set(order[:step])
                left = [(d, f) for d, f in mine if not f & before]
                gone = [d for d, f in left if letter in f]
                out[part, "".join(order), step + 1] = [
                    len(left) - len(gone), len(gone),
                    sum(letter in f for _, f in mine) - len(gone), sum(f == {letter} for _, f in mine),
                    sum(d in good for d in gone), sum(d in toxic for d in gone),
                ]
                removals[part, letter] = removals.get((part, letter), 0) + len(gone)
    return {k: (*v, removals[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def frames(spark, docs, labels):
    named = spark.createDataFrame(docs, "doc_id long, text string, source string").selectExpr(
        "*", "1 as mask", "'q' as part", "0 as n", "2 as id", "3 as good", "4 as quality", "'d' as digest"
    )
    return named.repartition(5), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("labels", [LABELS, []])
def test_documents(spark, labels):
    docs, marks = frames(spark, DOCS, labels)
    rows = filter_audit(docs, marks).collect()
    got = {tuple(r[:3]): tuple(r[3:]) for r in rows}
    assert len(rows) == len(got) == 4 * 120 * 5
    assert got == expected(DOCS, labels)


def test_empty_table(spark):
    docs, marks = frames(spark, [], LABELS)
    assert filter_audit(docs, marks).count() == 0


def test_clashing_label_columns(spark):
    docs, marks = frames(spark, DOCS[:6], LABELS)
    marks = marks.selectExpr("*", "'x' as part", "'y' as text", "9 as mask")
    assert {tuple(r[:3]): tuple(r[3:]) for r in filter_audit(docs, marks).collect()} == expected(DOCS[:6], LABELS)


def test_levels_hold_every_prefix_once(spark):
    steps = prefixes(spark.range(1))
    counts = {r.step: r["count"] for r in steps.groupBy("step").count().collect()}
    assert counts == {1: 5 * 32, 2: 20 * 32, 3: 60 * 32, 4: 120 * 32, 5: 120 * 32}
    assert steps.agg(F.countDistinct("prefix", "mask")).first()[0] == 325 * 32
