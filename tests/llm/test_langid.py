"""Language identification: held-out accuracy, Viterbi against enumeration, and edge rows."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from maskwright.llm import langid
from maskwright.llm.langid import fit, identify, label, viterbi


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = identify(docs).join(docs.select("doc_id", "lang"), "doc_id").cache()
    assert rows.count() == docs.count()
    held = rows.where("held_out")
    assert held.where("lang = lang_pred").count() >= 0.98 * held.count()
    assert rows.where("score < 0 or score > 1 or score is null").count() == 0
    rows.unpersist()


@pytest.mark.parametrize("seed", range(10))
def test_viterbi_finds_the_best_path(seed):
    rng = np.random.default_rng(seed)
    counts = rng.integers(0, 6, 5)
    scores = -rng.random((counts.sum(), 3)).astype(np.float32) * 3
    labels = viterbi(scores, counts, 1.0)
    ends = np.cumsum(counts)

    def total(path, own):
        return own[np.arange(len(path)), list(path)].sum() - sum(a != b for a, b in itertools.pairwise(path))

    for e, n in zip(ends, counts):
        own = scores[e - n : e]
        best = max((total(p, own) for p in itertools.product(range(3), repeat=int(n))), default=0)
        assert np.isclose(total(labels[e - n : e], own), best, atol=1e-5)


def test_edge_rows_and_spans(spark):
    en = "the cat and the dog went to the house with their friends "
    de = "der hund und die katze gehen mit ihren freunden nach hause "
    ru = "кошка и собака пошли домой вместе с друзьями "
    train = [(i, t * 3, lang) for i in range(40) for t, lang in ((en, "en"), (de, "de"), (ru, "ru"))]
    docs = spark.createDataFrame(train, "doc_id long, text string, lang string")
    model = fit(docs, F.lit(True))
    assert model.languages == ["de", "en", "ru"]
    cases = [
        (1, None), (2, ""), (3, "123 ... !"), (4, en * 2 + de * 2), (5, ru), (6, "日本語"),
        (7, en * 3000), (8, "İIß"), (8, "İIß"), (None, de),
    ]
    df = spark.createDataFrame(cases, "doc_id long, text string").selectExpr("*", "1 as label", "2 as row")
    rows = label(df, model, F.struct("*")).select("row.doc_id", "row.text", "label.*").collect()
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == len(cases)
    for i in (1, 2, 3):
        assert (by_id[i].lang_pred, by_id[i].score, by_id[i].spans) == ("und", 0.0, [])
    spans = by_id[4].spans
    assert [s.lang for s in spans] == ["en", "de"]
    assert abs(spans[0].end - 2 * len(en)) <= 6 and spans[1].end == len(by_id[4].text)
    assert by_id[5].lang_pred == "ru" and by_id[None].lang_pred == "de" and by_id[7].lang_pred == "en"
    assert by_id[6].lang_pred in model.languages and by_id[6].score == 0.0


def test_nothing_labelled_and_empty_table(spark):
    df = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [tuple(r)[2:4] for r in identify(df).collect()] == [("und", 0.0)]
    assert identify(df.limit(0)).count() == 0


def test_scripts_are_in_order():
    assert all(a[0] < b[0] for a, b in itertools.pairwise(langid.SCRIPTS))
