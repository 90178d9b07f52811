"""Fixed patterns against Python's matcher, and contexts that discover what they miss."""

import hashlib
import random
import re

import pytest

from maskwright.llm.pii import KINDS, find_personal_data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, raw):
    digits = re.sub("[^0-9]", "", raw)
    if kind == "ip":
        return all(int(p) <= 255 for p in raw.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base(text):
    return {
        k: [(m.start(), m.end()) for m in re.finditer(p, text or "") if valid(k, m.group())]
        for k, p in PATTERNS.items()
    }


def row(doc_id, text):
    found = base(text)
    joined = ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in found[k])
    return (doc_id, *(len(found[k]) for k in KINDS), hashlib.sha256(joined.encode()).hexdigest())


def got(df):
    return sorted((tuple(r) for r in df.drop("spans").collect()), key=repr)


def made(seed):
    rng = random.Random(seed)
    bits = ["a@b.c", "x_d@e-f.g.h", "@", "..", "1.2.3.4", "256.1.1.1", "0001.2.3.255", ".5", "+7", " ", "-", "  ",
            "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (988) 555-2485", "(", ")", "9", "12", "é", "𝄞", "\n",
            "", "", "٠", "%", "+", "4" * 25, "word"]
    return [(i, "".join(rng.choices(bits, k=rng.randrange(1, 14)))) for i in range(250)]


@pytest.mark.parametrize("seed", range(2))
def test_fixed_patterns(spark, seed):
    docs = made(seed) + [(900, None), (901, ""), (None, "a@b.cd"), (5, "a@b.cd"), (5, "a@b.cd")]
    docs += [(902, "9 " * 20_000), (903, "a." * 20_000 + "@"), (904, "x" * 60_000), (905, "+" + "1-" * 20_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as h", "2 as found", "3 as body")
    rows = find_personal_data(df).cache()
    assert got(rows) == sorted((row(*d) for d in docs), key=repr)
    spans = {(r.doc_id, r.base_sha256): r.spans for r in rows.collect()}
    for d, t in docs:
        found = base(t)
        own = [f"{k}:{a}:{b}" for k in KINDS for a, b in found[k]]
        assert set(own) <= set(spans[d, row(d, t)[5]].split(","))
    rows.unpersist()


def test_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert got(find_personal_data(df)) == sorted((row(r.doc_id, r.text) for r in df.collect()), key=repr)


def test_contexts_find_unseen_identifiers(spark):
    docs = [(i, f"Some words and reach me at user{i}@mail.example.com now") for i in range(8)]
    docs += [(20, "Again, reach me at user 77 or reach me at bob77(at)mail9021 thanks")]
    docs += [(30 + i, f"There were about {1000 + i} people and {i} cars") for i in range(9)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = {r.doc_id: r for r in find_personal_data(df).collect()}
    text = docs[8][1]
    start = text.index("bob77")
    assert rows[20].n_email == 0
    assert rows[20].spans == f"email:{start}:{start + len('bob77(at)mail9021')}"
    assert all(rows[30 + i].spans == "" for i in range(9))
    assert rows[3].spans.count("email") == 1


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert find_personal_data(df).count() == 0


def test_identifiers_with_blanks(spark):
    def luhn(i):
        return next(c for c in (f"4111 1111 11{i:02d} 111{d}" for d in range(10)) if valid("card", c))

    docs = [(i, f"please call now +49 171 23456{i:02d} soon") for i in range(12)]
    docs += [(20 + i, f"my 2 cards, charge card {luhn(i)}, thanks") for i in range(12)]
    docs += [
        (50, "call now 8 495 123 45 67 or later"), (51, "please call now 0171 234 5678."),
        (52, "call now (0171) 234-56 78, then"), (53, "charge card 4111 1111 1111 1112, thanks"),
        (54, "call now 12 times"), (55, "x7 " + "word " * 40 + "call now" + " " * 130 + "0171 234 5678"),
        (56, "call now 0171 234 5678abc"), (57, "call now covid19 2020 31"),
    ]
    rows = {r.doc_id: r.spans for r in find_personal_data(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    texts = dict(docs)

    def span(kind, i, raw):
        at = texts[i].index(raw)
        return f"{kind}:{at}:{at + len(raw)}"

    assert rows[3] == span("phone", 3, "+49 171 2345603")
    assert rows[50] == span("phone", 50, "8 495 123 45 67")
    assert rows[51] == span("phone", 51, "0171 234 5678")
    assert rows[52] == span("phone", 52, "0171) 234-56 78")
    assert rows[53] == span("card", 53, "4111 1111 1111 1112")
    assert rows[54] == ""
    assert rows[55] == span("phone", 55, "0171 234 5678")
    assert rows[56] == span("phone", 56, "0171 234")


def test_a_number_before_an_identifier_is_a_word_of_its_context(spark):
    docs = [(i, f"room a1 user{i}@mail.example.com") for i in range(8)] + [(20, "room a1 bob77(at)mail9021")]
    rows = {r.doc_id: r.spans for r in find_personal_data(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert rows[20] == f"email:8:{8 + len('bob77(at)mail9021')}"
