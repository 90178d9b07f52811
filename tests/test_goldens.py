"""Hand-made inputs with known results."""

import pytest

from maskwright import detect, mask, restore

MASKED = [
    ("Contact: ivan.petrov@example.ru, phone +7 (495) 123-45-67.",
     "Contact: <EMAIL_001>, phone <PHONE_001>."),
    ("ИНН: 7707083893", "ИНН: <INN_001>"),
    ("ИНН: 7707083890", "ИНН: 7707083890"),
    ("Card 4111 1111 1111 1111", "Card <CARD_001>"),
    ("Card 4111 1111 1111 1112", "Card 4111 1111 1111 1112"),
    ("a@x.ru and b@x.ru and c@x.ru", "<EMAIL_001> and <EMAIL_002> and <EMAIL_003>"),
    ("INN 7707083893 only", "INN <INN_001> only"),
    ("почтаa@x.ru éb@y.com", "почта<EMAIL_001> é<EMAIL_002>"),
    ("тел +7 495 123 45 67 конец", "тел <PHONE_001> конец"),
    ("see https://u@host.ru/x?12.05.2026 and 10.0.0.1", "see <URL_001> and <IP_001>"),
    ("see https://u@host.ru/x?12.05.2026", "see <URL_001>"),
    ("СНИЛС 112-233-445 95, 4111 1111 1111 1111 2026", "СНИЛС <SNILS_001>, <CARD_001> 2026"),
    ("8 495 123 45 67 89", "<PHONE_001> 89"),
    ("x 500100732259 y", "x <INN_001> y"),
    ("😀 a@x.ru", "😀 <EMAIL_001>"),
    ("12.05.2026", "<DATE_001>"),
    # Separators that count as blanks, and one that does not.
    *[(f"+7{b}495{b}123{b}45{b}67", "<PHONE_001>") for b in "\u00A0\u2003\u3000\uFEFF"],
    ("+7\u200B4951234567", "+7\u200B4951234567"),
    # A plus after a digit does not start a number, the seven after it does.
    ("5+7 495 123 45 67", "5+<PHONE_001>"),
    ("0123456789+7 495 123 45 67", "0123456789+<PHONE_001>"),
    # The domain ends at the last word border, wherever that is.
    ("a@x.y.ru_", "<EMAIL_001>.ru_"),
    ("a@x.ru_", "a@x.ru_"),
    ("a@x.y-ru_", "<EMAIL_001>ru_"),
    ("a@x.ru-", "<EMAIL_001>-"),
    ("a@x.ru...", "<EMAIL_001>..."),
    ("a@x..ru", "a@x..ru"),
    ("a@x.ru+b@y.com", "<EMAIL_001><EMAIL_002>"),
    (".a@x.ru", ".<EMAIL_001>"),
    ("é.a@x.ru", "é.<EMAIL_001>"),
    ("http://a.b http:// xhttp://c", "<URL_001> http:// xhttp://c"),
    ("010.001.000.255 1.2.3.256 1.2.3.4.5", "<IP_001> 1.2.3.256 <IP_002>.5"),
    ("31/12.1999 32.12.1999 1.13.2000 01.01.2100 1.1.2000x",
     "<DATE_001> 32.12.1999 1.13.2000 01.01.2100 1.1.2000x"),
    ("112-233-445-95 112 233 445 95", "<SNILS_001> 112 233 445 95"),
    ("11223344595", "11223344595"),
    # A private-use character, which positions must not be thrown off by.
    ("\uE000a@x.ru\uE000 1.1.2000", "\uE000<EMAIL_001>\uE000 <DATE_001>"),
]


@pytest.fixture(scope="module")
def masked(spark):
    df = spark.createDataFrame(list(enumerate(t for t, _ in MASKED)), "id int, text string")
    rows = mask(df, "text", ["id"], entities_field="e").collect()
    return {r.id: r for r in rows}


@pytest.mark.parametrize("index", range(len(MASKED)))
def test_masked_text(masked, index):
    assert masked[index].masked.masked_text == MASKED[index][1]


@pytest.mark.parametrize("index", range(len(MASKED)))
def test_positions_are_those_of_the_originals(masked, index):
    row, text = masked[index], MASKED[index][0]
    assert [text[e.start:e.end] for e in row.e] == [e.original for e in row.e]
    assert all(a.end <= b.start for a, b in zip(row.e, row.e[1:]))


def test_counter_goes_past_three_digits(spark):
    text = " ".join(f"u{i}@x.ru" for i in range(1001))
    df = spark.createDataFrame([(1, text)], "id int, text string")
    out = mask(df, "text", ["id"]).select("masked.masked_text").first()[0]
    assert out.endswith("<EMAIL_999> <EMAIL_1000> <EMAIL_1001>")


def _detect(spark, text, **options):
    df = spark.createDataFrame([(text,)], "text string")
    return detect(df, **options).first().pii


def test_detect_filters_by_category(spark):
    text = "Email a@x.ru, phone +7 495 123 45 67"
    assert _detect(spark, text).total_count == 2
    only = _detect(spark, text, categories=["EMAIL"])
    assert (only.total_count, only.found_pii[0].category) == (1, "EMAIL")
    assert _detect(spark, text, categories=["phone"]).total_count == 1
    assert _detect(spark, text, categories=["NAME", "IBAN"]).total_count == 0
    assert _detect(spark, text, categories=[]).total_count == 2


def test_detect_counts_all_and_shows_three(spark):
    pii = _detect(spark, "a@x.ru b@x.ru c@x.ru d@x.ru e@x.ru")
    assert pii.found_pii[0]["count"] == 5
    assert pii.found_pii[0].samples == ["a@x.ru", "b@x.ru", "c@x.ru"]
    assert _detect(spark, "a@x.ru", include_samples=False).found_pii[0].samples == []


def test_detect_counts_what_overlaps(spark):
    pii = _detect(spark, "see https://u@host.ru/x?12.05.2026")
    assert [f.category for f in pii.found_pii] == ["EMAIL", "URL", "DATE"]
    assert pii.total_count == 3


def _round_trip(spark, text, change=lambda t: t):
    df = spark.createDataFrame([(1, text)], "id int, text string")
    row = mask(df, "text", ["id"], entities_field="e").first()
    again = spark.createDataFrame(
        [(change(row.masked.masked_text), row.e)],
        "text string, entities array<struct<category:string,placeholder:string,"
        "original:string,start:int,end:int>>",
    )
    return restore(again).first().restored


def test_restore_reverses_mask(spark):
    out = _round_trip(spark, "Email me at user@example.com please.")
    assert out.restored_text == "Email me at user@example.com please."
    assert out.hallucinated == []


def test_restore_flags_made_up_placeholders(spark):
    out = _round_trip(spark, "My email is real@x.ru.", lambda t: t + " See also <PHONE_999>.")
    assert out.hallucinated == ["<PHONE_999>"]


def test_restore_replaces_every_occurrence(spark):
    out = _round_trip(spark, "a@x.ru", lambda t: f"{t} again {t}")
    assert out.restored_text == "a@x.ru again a@x.ru"


def test_text_that_already_holds_a_placeholder_is_changed(spark):
    """Restoring is not an inverse here; ``preexisting_placeholder`` finds such rows."""
    out = _round_trip(spark, "<EMAIL_001> is a@x.ru")
    assert out.restored_text == "a@x.ru is a@x.ru"
