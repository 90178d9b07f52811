"""Removing repeated passages, against a plain count of windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as contract
from maskwright.llm.automata import Automaton, Passages, remove_repeated_passages

SCHEMA = "doc_id long, text string"


def expected(docs, window):
    words = [(t or "").encode().split() for _, t in docs]
    counts = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(docs, words):
        goes = np.zeros(len(w), bool)
        for i in range(len(w) - window + 1):
            if counts[tuple(w[i : i + window])] > 1:
                goes[i : i + window] = True
        kept = b" ".join(x for x, gone in zip(w, goes) if not gone)
        out.append((d, len(w), int(goes.sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed, letters, docs, window):
    draw = random.Random(seed)
    passages = [[draw.choice(letters) for _ in range(draw.randint(window - 1, 3 * window))] for _ in range(6)]
    out = []
    for i in range(docs):
        words = []
        for _ in range(draw.randint(0, 4)):
            words += [draw.choice(letters) for _ in range(draw.randint(0, 2 * window))]
            if draw.random() < 0.6:
                words += draw.choice(passages)
        out.append((i, draw.choice([" ", "\n", " \t", "\v"]).join(words)))
    return out


EXTRA = [
    (None, "null id " * 12), (None, None), (5, None), (5, ""), (900, "A b É   " * 30), (901, "a b É   " * 30),
    (902, "x " * 500), (903, "y z " * 300), (904, "one two three " * 2000), (904, "one two three " * 2000), (905, "q"),
    (906, "퟿ word " * 40),
]


@pytest.mark.parametrize(
    "letters, hot, shard_words, most",
    [("ab", 4096, 200_000, 10**6), ("abcdefghij" * 3, 3, 50, 10**6), ("abc", 1, 7, 10**6), ("abcd", 3, 50, 2)],
)
def test_documents(spark, letters, hot, shard_words, most):
    docs = corpus(hot, letters, 60, 12) + EXTRA
    named = spark.createDataFrame(docs, SCHEMA).selectExpr(
        "*", "1 as d", "'x' as t", "2 as anchor", "3 as s", "4 as lo", "5 as spans", "6 as c"
    )
    got = remove_repeated_passages(
        named.repartition(7), window=12, gram=4, hot=hot, most=most, shard_words=shard_words
    )
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected(docs, 12)


def test_phrase_in_a_third_of_all_documents(spark):
    """The same words in ever new surroundings: their windows are dealt out one by one."""
    draw = random.Random(3)
    fresh = lambda n: " ".join(str(draw.random()) for _ in range(n))
    phrase = " ".join(f"common{i}" for i in range(50))
    docs = [(i, f"{fresh(40)} {phrase if i % 3 == 0 else ''} {fresh(40)}") for i in range(900)]
    got = remove_repeated_passages(spark.createDataFrame(docs, SCHEMA), hot=100)
    rows = {r.doc_id: r.n_removed for r in got.collect()}
    assert rows == {i: 50 if i % 3 == 0 else 0 for i in range(900)}


def test_kept_text_and_empty_table(spark):
    docs = [(1, "a b c d e"), (2, "x  b c d y"), (3, None)]
    got = remove_repeated_passages(spark.createDataFrame(docs, SCHEMA), window=3, gram=2, kept_text=True)
    assert {r.doc_id: r.kept for r in got.collect()} == {1: "a e", 2: "x y", 3: ""}
    assert remove_repeated_passages(spark.createDataFrame([], SCHEMA)).count() == 0


def test_automaton_counts_strings():
    draw = random.Random(9)
    for _ in range(50):
        texts = [([draw.randint(0, 2) for _ in range(draw.randint(0, 9))], draw.randint(1, 3)) for _ in range(5)]
        known = Automaton()
        for words, count in texts:
            known.add(words, count)
        known.finish()
        for window in (1, 2, 3, 4):
            counts = Counter()
            for words, count in texts:
                for i in range(len(words) - window + 1):
                    counts[tuple(words[i : i + window])] += count
            for words, _ in texts + [([draw.randint(0, 3) for _ in range(12)], 0)]:
                goes = set()
                for i in range(len(words) - window + 1):
                    if counts[tuple(words[i : i + window])] > 1:
                        goes |= set(range(i, i + window))
                runs = known.repeated(words, window)
                assert {p for a, b in zip(runs[::2], runs[1::2]) for p in range(a, b)} == goes
                assert all(a > b for a, b in zip(runs[2::2], runs[1::2]))


def test_equal_windows_lie_in_passages_of_one_anchor():
    found = Passages([b"a " * 10 + b"b c d e f g h i j k l", b"b c d e f g h i j k l"], 6, 2)
    assert sum(found.n) == 21 - 5 + 11 - 5 and found.n.max() <= 5
    anchors = [dict() for _ in range(2)]
    for text, lo, n, anchor in zip(found.text, found.lo, found.n, found.anchor):
        anchors[text].update({int(lo) + i: anchor for i in range(n)})
    assert [anchors[0][10 + i] for i in range(6)] == [anchors[1][i] for i in range(6)]


def test_query_removes_whole_windows_of_documents(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = contract.queries()["op11_substring_dedup"](spark, sf_dir)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected(docs, 35)
