"""The pandas form gives what the built-in form gives."""

import random

from maskwright import mask
from tests.arrow_form import mask_arrow
from tests.test_goldens import MASKED
from tests.test_long_texts import PIECES


def test_both_forms_agree(spark):
    rng = random.Random(11)
    texts = [t for t, _ in MASKED]
    texts += ["".join(rng.choices(PIECES, k=rng.randint(1, 25))) for _ in range(6000)]
    df = spark.createDataFrame(list(enumerate(t for t in texts if t)), "id int, text string")
    built_in = mask(df, "text", ["id"], entities_field="e").select("id", "masked.masked_text", "e")
    arrow = mask_arrow(df, entities_field="e").select("id", "masked.masked_text", "e")
    want = {r.id: (r.masked_text, [e.asDict() for e in r.e]) for r in built_in.collect()}
    got = {r.id: (r.masked_text, [e.asDict() for e in r.e]) for r in arrow.collect()}
    assert got == want


def test_empty_batches_and_bad_rows(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "x")], "id int, text string")
    kept = {r.id: r for r in mask_arrow(df, on_error="keep").collect()}
    assert kept[3].masked.masked_text == "x" and kept[3].error is None
    assert kept[1].masked is None and kept[1].error and kept[2].error
