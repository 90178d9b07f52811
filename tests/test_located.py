"""Positions of matches by plain search."""

from maskwright.functions import spans
from maskwright.operators.detect import hits_long
from maskwright.operators.mask import mask
from tests.test_plans import plan_of

TEXTS = [
    "mail a@x.ru and aa@x.ru, then a@x.ru",
    "call 89161234567, not 889161234567 nor 8 916 123 45 67",
    "10.1.1.1 in 110.1.1.1 and 10.1.1.11, on 1.2.2020 or 11.2.2020",
    "\U0001f600 \u00e9 https://x.ru/a?\U0001f600 a@x.ru 4111 1111 1111 1111 https://x.ru/a",
    "inn 7707083893 and 7707083894, card 4111-1111-1111-1112 4111 1111 1111 1111",
    " ".join(f"u{i}@x.ru" for i in range(20)),
    "nothing",
]


def found(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, t string")
    return [tuple(r) for r in hits_long(df, "t").orderBy("id", "start", "category").collect()]


def test_plain_search_gives_the_same_places(spark, monkeypatch):
    quick = found(spark)
    monkeypatch.setattr(spans, "LOCATED", -1)
    assert quick == found(spark)
    assert all(TEXTS[i][start:end] == raw for i, _, _, raw, start, end in quick)


def test_few_matches_are_placed_by_plain_search(spark):
    df = spark.createDataFrame([(1, "a@x.ru")], "id int, t string")
    assert "position(" in plan_of(mask(df, "t", ["id"]))


def test_broken_utf8_keeps_its_places(spark, monkeypatch):
    df = spark.sql("SELECT CAST(unhex('687474703A2F2F61FF62206361FF') AS STRING) AS t")
    quick = [r.start for r in hits_long(df, "t").collect()]
    monkeypatch.setattr(spans, "LOCATED", -1)
    assert quick == [r.start for r in hits_long(df, "t").collect()]
