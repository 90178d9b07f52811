"""Ids without matching."""

import pytest

from maskwright.operators.mask import mask, with_mapping_id
from maskwright.plans import QUERIES
from tests.test_plans import plan_of


def test_ids_match_no_text(spark, sf_dir):
    assert "regexp" not in plan_of(QUERIES["mapping_id"](spark, sf_dir)).lower()
    df = spark.createDataFrame([(1, "a@x.ru"), (2, "b"), (2, "b")], "id int, t string")
    ids = mask(df, "t", ["id"], "w").select("masked.mapping_id").collect()
    assert ids == with_mapping_id(df, "t", ["id"], "w").select("mapping_id").collect()
    bad = spark.createDataFrame([(1, None)], "id int, t string")
    with pytest.raises(Exception, match="Text is empty"):
        with_mapping_id(bad, "t", ["id"]).select("id").collect()
