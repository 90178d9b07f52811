"""Decontamination against a walk over all windows in plain Python."""

import hashlib
import random
import re

import pytest

from maskwright.llm.common import fold
from maskwright.llm.decontaminate import clean, decontaminate

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute(docs, items, window=13):
    split = [(str(i) if i is not None else "", WORD.findall(fold(t or ""))) for i, t in items]
    grams = {}
    for name, words in split:
        m = min(window, len(words))
        for k in range(len(words) - m + 1 if m else 0):
            grams.setdefault(m, {}).setdefault(tuple(words[k : k + m]), set()).add(name)
    out = []
    for d, t in docs:
        words = WORD.findall(fold(t or ""))
        hit, found = set(), set()
        for m, known in grams.items():
            for k in range(len(words) - m + 1):
                names = known.get(tuple(words[k : k + m]))
                if names:
                    hit.update(range(k, k + m))
                    found |= names
        ids = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((d, len(words), len(hit), len(found), ids, len(hit) > 0 and 20 * len(hit) >= len(words)))
    return sorted(out, key=repr)


def got(df):
    return sorted(
        (tuple(r) for r in df.drop("longest_words", "matches").collect()), key=repr
    )


def made(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "É", "é", "c1", "x" * 300, "日本"]
    text = lambda n: rng.choice([" ", "-", "\n", "_"]).join(rng.choices(vocabulary, k=n))
    items = [(i, text(rng.choice([0, 1, 2, 5, 13, 14, 40]))) for i in range(12)]
    items += [(3, "a a"), (None, "zq b"), (50, None), (51, ""), (52, "...")]
    docs = [(i, text(rng.choice([0, 1, 3, 20, 60]))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "q " * 3000 + "ZQ b"), (None, "zq  b"), (5, docs[5][1])]
    docs += [(200 + k, "lead " + (t or "") + " tail") for k, (_, t) in enumerate(items)]
    return docs, items


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("block_bytes", [32 << 20, 500])
def test_against_brute_force(spark, seed, block_bytes):
    docs, items = made(seed)
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as row", "2 as found")
    b = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as name")
    assert got(decontaminate(d, b, block_bytes=block_bytes)) == brute(docs, items)
    dirty = [r[5] for r in brute(docs, items)]
    assert clean(d, b, block_bytes=block_bytes).count() == dirty.count(False)
    assert clean(d, b).columns == d.columns


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert got(decontaminate(d, b.limit(0))) == brute([(1, "a b")], [])
    assert decontaminate(d.limit(0), b).count() == 0


def test_matches_have_places_and_lengths(spark):
    words = [f"w{i}" for i in range(30)]
    d = spark.createDataFrame([(1, "x " + " ".join(words[3:20]) + " y")], "doc_id long, text string")
    b = spark.createDataFrame([(9, " ".join(words))], "item_id long, text string")
    row = decontaminate(d, b).first()
    assert [tuple(m) for m in row.matches] == [("9", 3, 1, 17)]
    assert (row.n_hit, row.longest_words, row.contaminated) == (17, 17, True)
