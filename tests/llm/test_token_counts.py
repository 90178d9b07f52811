"""Edited counts against encoding the edited text as a whole."""

import random

import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from maskwright.llm.queries import EDITED
from maskwright.llm.token_counts import Counter, Tree, apply_edits, count_edited, redactions, trees

PATH = P.path("byte_bpe_50k.tiktoken")
COUNTER = Counter(PATH, P.PATTERN)


def whole(text):
    return len(COUNTER.encoding.encode_ordinary(text))


TEXT = st.text(alphabet="ab '.\n\t 1é日𝄞s!", max_size=60)


@settings(max_examples=400, deadline=None)
@given(TEXT, st.lists(st.tuples(st.integers(0, 60), st.integers(0, 8), TEXT), max_size=4))
def test_every_edit_gives_the_count_of_the_whole(text, edits):
    tree = Tree(text, COUNTER)
    for start, size, new in edits:
        start = min(start, len(tree.text))
        tree.edit(start, min(len(tree.text), start + size), new)
        assert tree.tokens == whole(tree.text)
        assert [x for s, _ in tree.leaves for x in s] == list(map(len, COUNTER.pattern.findall(tree.text)))
        assert tree.chars[1] == len(tree.text)


def test_long_texts_encode_little():
    rng = random.Random(3)
    text = " ".join(f"word{rng.randrange(999)}" for _ in range(50_000))
    tree = Tree(text, COUNTER)
    again = tree.apply([(i, i + 3, "new  text") for i in range(100, len(text) - 10, len(text) // 40)])
    assert tree.tokens == whole(tree.text)
    assert again < 1000
    tree.edit(10, 10, "x y " * 3000)
    assert tree.tokens == whole(tree.text)


def test_overlapping_edits_are_refused():
    with pytest.raises(ValueError):
        Tree("some text", COUNTER).apply([(0, 4, ""), (3, 5, "")])


def brute(docs, edits_of):
    out = []
    for d, t in docs:
        t = t or ""
        edited, at = [], 0
        edits = edits_of(t)
        for a, b, new in edits:
            edited += [t[at:a], new]
            at = b
        out.append((d, whole(t), len(COUNTER.pattern.findall(t)), len(edits), whole("".join([*edited, t[at:]]))))
    return sorted(out, key=repr)


def test_documents(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    edits_of = redactions(*EDITED)
    rows = count_edited(df, PATH, P.PATTERN, edits_of).drop("n_reencoded").collect()
    want = brute([(r.doc_id, r.text) for r in df.collect()], edits_of)
    assert sorted(map(tuple, rows), key=repr) == want
    assert sum(r[3] for r in want) > 0


def test_edge_rows(spark):
    docs = [(1, None), (2, ""), (3, "a@b.cd"), (None, "x"), (3, "a@b.cd"), (4, "word " * 50_000 + "a@b.cd")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as n_tokens")
    edits_of = redactions(r"\S+@\S+", "<X>")
    rows = count_edited(df, PATH, P.PATTERN, edits_of).drop("n_reencoded").collect()
    assert sorted(map(tuple, rows), key=repr) == brute(docs, edits_of)
    assert count_edited(df.limit(0), PATH, P.PATTERN, edits_of).count() == 0


def test_kept_trees_are_edited_later(spark):
    docs = [(1, "one two three"), (2, None), (3, "four")]
    kept = trees(spark.createDataFrame(docs, "doc_id long, text string"), PATH, P.PATTERN)
    edits = F.when(F.col("doc_id") == 1, F.expr("array(struct(4 as start, 7 as stop, 'zwei drei' as new))"))
    rows = {r.doc_id: r for r in apply_edits(kept.withColumn("edits", edits), PATH, P.PATTERN).collect()}
    assert rows[1].text == "one zwei drei three" and rows[1].n_tokens == whole(rows[1].text)
    assert (rows[2].n_tokens, rows[3].n_tokens, rows[3].n_reencoded) == (0, whole("four"), 0)
