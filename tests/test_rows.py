"""Bad rows, passthrough, workspaces and ids."""

import json
import random

import pytest
from pyspark.sql import functions as F

from maskwright import detect, mask, private_enrich, restore, restore_with_mapping, vault_rows
from maskwright.functions import rows
from maskwright.functions.placeholders import dropped_elements, pairs_from_json
from maskwright.functions.sql import register_views
from maskwright.operators.audit import dataset_audit, row_audit, row_json
from maskwright.operators.detect import count_columns, detect_counts, detect_samples, hits, hits_long
from maskwright.operators.enrich import private_enrich_column
from maskwright.operators.mask import mask_entities, without_text
from maskwright.sources.vault import write_masked

BAD = [(1, "a@x.ru"), (2, ""), (3, None)]


@pytest.fixture
def bad(spark):
    return spark.createDataFrame(BAD, "id int, text string")


@pytest.mark.parametrize(
    "run", [lambda d, m: mask(d, "text", ["id"], on_error=m), lambda d, m: detect(d, on_error=m)]
)
def test_fail_ends_the_run_and_keep_keeps_the_rows(bad, run):
    with pytest.raises(Exception, match="Text is empty"):
        run(bad, "fail").collect()
    kept = {r.id: r for r in run(bad, "keep").collect()}
    assert len(kept) == 3
    assert kept[1].error is None
    assert kept[2].error.startswith("Text is empty") and kept[3].error.startswith("Text is empty")
    assert (kept[2][2], kept[3][2]) == (None, None)


def test_unknown_options_are_refused(bad):
    with pytest.raises(ValueError):
        mask(bad, "text", ["id"], policy="loose")
    with pytest.raises(ValueError):
        mask(bad, "text", ["id"], on_error="ignore")
    with pytest.raises(ValueError):
        vault_rows(bad, "text")


def test_earlier_errors_stay(spark):
    df = spark.createDataFrame([("a@x.ru", "before"), ("", "before")], "text string, error string")
    got = sorted(r.error for r in detect(df, on_error="keep").collect())
    assert got == ["Text is empty.", "before"]


def test_output_field_overwrites_and_the_rest_passes_through(spark):
    df = spark.createDataFrame([(1, "a@x.ru", 5)], "id int, text string, masked int")
    out = mask(df, "text", ["id"])
    assert out.columns == ["id", "text", "masked"]
    assert out.first().masked.masked_text == "<EMAIL_001>"


def test_mapping_id_is_stable_and_apart_per_workspace_and_key(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x")], "id int, text string")

    def ids(**options):
        return [r[0] for r in mask(df, "text", ["id"], **options).select("masked.mapping_id").collect()]

    assert ids() == ids()
    assert len(set(ids() + ids(workspace="other"))) == 4
    assert ids() == ids(workspace="")
    joined = spark.createDataFrame([("a", "b,c"), ("a,b", "c")], "k string, l string")
    both = mask(joined, F.lit("t"), ["k", "l"]).select("masked.mapping_id").distinct().count()
    assert both == 2


def test_public_output_holds_no_originals(spark):
    df = spark.createDataFrame([(1, "a@x.ru")], "id int, text string")
    out = mask(df, "text", ["id"]).first().masked.asDict(recursive=True)
    assert out["entities"] == [
        {"placeholder": "<EMAIL_001>", "category": "EMAIL", "confidence": 0.7}
    ]
    assert "a@x.ru" not in str(out)


def test_restore_needs_a_mapping_id(spark):
    df = spark.createDataFrame([("x", None), ("x", ""), ("", "i")], "text string, mapping_id string")
    vault = vault_rows(spark.createDataFrame([(1, "a@x.ru")], "id int, t string"), "t", ["id"])
    got = [r.error for r in restore_with_mapping(df, vault, on_error="keep").collect()]
    assert sorted(got) == ["Mapping ID is required.", "Mapping ID is required.", "Text is empty."]


def test_workspaces_are_apart(spark):
    """Both workspaces use the same mapping id; each gets its own value back."""
    entity = "array<struct<category:string,placeholder:string,original:string,start:int,end:int>>"
    vault = spark.createDataFrame(
        [("a", "i", [("NAME", "<NAME_001>", "Ann", 0, 3)]),
         ("b", "i", [("NAME", "<NAME_001>", "Bob", 0, 3)])],
        f"workspace_id string, mapping_id string, entities {entity}",
    )
    df = spark.createDataFrame(
        [("a",), ("b",), ("c",)], "ws string"
    ).withColumn("text", F.lit("<NAME_001>")).withColumn("mapping_id", F.lit("i"))
    out = restore_with_mapping(df, vault, workspace=F.col("ws"))
    assert {r.ws: r.restored.restored_text for r in out.collect()} == {
        "a": "Ann", "b": "Bob", "c": "<NAME_001>"
    }


ENTITY_JSON = [
    (None, 0),
    ("", 0),
    ("nonsense", 0),
    ("null", 0),
    ('{"placeholder":"<A_001>","original":"x"}', 0),
    ('[{"placeholder":"<A_001>","original":"x"}', 0),
    ('[{"placeholder":"<A_001>","original":"x"}]', 1),
    (' [ {"placeholder":"<A_001>","original":"x","start":1,"more":[1]} ] ', 1),
    ('[{"placeholder":1,"original":"x"}]', 0),
    ('[{"placeholder":"<A_001>","original":2}]', 0),
    ('[{"placeholder":"<A_001>"}]', 0),
    ('[{"placeholder":"<A_001>","original":null}]', 0),
    ('[{"placeholder":"","original":"x"}]', 0),
    ('[null,1,"s",[],{"placeholder":"<A_001>","original":""}]', 1),
]


def test_entity_lists_in_every_shape(spark):
    df = spark.createDataFrame([(i, j) for i, (j, _) in enumerate(ENTITY_JSON)], "i int, j string")
    got = {
        r.i: r.n for r in df.select("i", F.size(pairs_from_json(F.col("j"))).alias("n")).collect()
    }
    assert got == {i: n for i, (_, n) in enumerate(ENTITY_JSON)}


def test_hallucinated_keeps_first_order_and_three_digits(spark):
    df = spark.createDataFrame(
        [("<B_002> <A_001> <B_002> <A_0001> <a_001> <C_003>",
          '[{"placeholder":"<C_003>","original":"<C_003>"}]')],
        "text string, entities string",
    )
    assert restore(df).first().restored.hallucinated == ["<B_002>", "<A_001>"]


def test_enrichment_sees_masked_text_only(spark):
    df = spark.createDataFrame([(1, "I am a@x.ru"), (2, "nothing"), (3, "")], "id int, text string")
    seen = []

    def answer(sent):
        seen.extend(sent.collect())
        return sent.where("masked_prompt <> 'nothing'").selectExpr(
            "mapping_id", "concat(masked_prompt, '!') AS masked_response"
        )

    out = private_enrich(df, "text", answer, ["id"], model="m", on_error="keep")
    got = {r.id: (r.enriched and r.enriched.response, r.error) for r in out.collect()}
    assert got == {1: ("I am a@x.ru!", None), 2: ("", None), 3: (None, rows.PROMPT_EMPTY)}
    assert all("a@x.ru" not in str(r) for r in seen) and len(seen) == 2


def test_model_must_not_be_empty(spark):
    df = spark.createDataFrame([(1, "x")], "id int, text string")
    out = private_enrich_column(
        df, "text", F.upper, ["id"], "__custom__", "  ", on_error="keep"
    )
    assert out.first().error == rows.MODEL_EMPTY


def test_rows_without_labels_are_audited(spark):
    docs = spark.createDataFrame([(1, "a@x.ru"), (2, "b@x.ru c@x.ru"), (3, "none")], "id int, text string")
    labels = spark.createDataFrame([(1, 0)], "id int, quality int")
    out = dataset_audit(docs, ["quality"], "text", ["EMAIL"], labels=labels, key=["id"])
    assert sorted(map(tuple, out.collect()), key=repr) == [(0, 1, "EMAIL", 1, 1), (None, 2, "EMAIL", 2, 1)]


def _json_pairs(text):
    """What a JSON reader that keeps the last value of a repeated key makes of a list."""
    try:
        found = json.loads(text)
    except ValueError:
        return None
    if not isinstance(found, list):
        return None
    out = []
    for e in found:
        p, o = (e.get("placeholder"), e.get("original")) if isinstance(e, dict) else (None, None)
        out.append((p, o) if isinstance(p, str) and isinstance(o, str) and p else None)
    return out


@pytest.mark.parametrize("allowed", ["true", "false"])
def test_entity_lists_are_read_as_json_is(spark, allowed):
    """With the setting, and without it (then objects within objects do not repeat keys)."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", allowed)
    rng = random.Random(8)
    names = ["placeholder", "original", "x", "origin\\u0061l"]

    def value(depth):
        kinds = ['"<A_001>"', '"a\\n\\"b\\\\"', '"é\\u0041"', '"{\\"placeholder\\":\\"p\\",\\"original\\":\\"o\\"}"',
                 "1", "null", "true", '""']
        if depth and rng.random() < 0.3:
            return rng.choice([member(depth - 1), f"[{value(depth - 1)}, {value(depth - 1)}]"])
        return rng.choice(kinds)

    def member(depth):
        if not depth and allowed == "false":
            return '{"original": "x", "y": 1}'
        pairs = [f'"{rng.choice(names)}"{rng.choice([":", " : "])}{value(depth)}' for _ in range(rng.randint(0, 5))]
        return "{" + rng.choice([",", " , "]).join(pairs) + "}"

    texts = []
    for _ in range(1500):
        inner = ",".join(rng.choice([member, member, value])(1) for _ in range(rng.randint(0, 4)))
        texts.append(rng.choice(["[{}]", " [{}] ", "[{}]", "{}", "[{}"]).format(inner))
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", pairs_from_json(F.col("t")).alias("p"), dropped_elements(F.col("t")).alias("n")
    )
    for t, pairs, dropped in df.collect():
        want = _json_pairs(t)
        assert [tuple(p) for p in pairs] == [p for p in want or [] if p], t
        assert dropped == sum(p is None for p in want or []), t
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def test_public_entities_restore_nothing(spark):
    df = spark.createDataFrame([(1, "a@x.ru")], "id int, text string")
    masked = mask(df, "text", ["id"]).withColumn("body", F.col("masked.masked_text"))
    got = restore(masked, "body", F.col("masked.entities")).first().restored
    assert got.restored_text == "<EMAIL_001>" and got.hallucinated == ["<EMAIL_001>"]


@pytest.mark.parametrize(
    "run",
    [
        lambda d, **o: vault_rows(d, "text", ["id"], **o),
        lambda d, **o: mask_entities(d, "text", ["id"], **o),
        lambda d, **o: hits(d, **o),
        lambda d, **o: hits_long(d, **o),
        lambda d, **o: count_columns(d, **o),
        lambda d, **o: detect_counts(d, ["id"], **o),
        lambda d, **o: detect_samples(d, ["id"], **o),
        lambda d, **o: dataset_audit(d, ["id"], **o),
    ],
)
def test_every_operator_refuses_bad_rows(bad, run):
    with pytest.raises(Exception, match="Text is empty"):
        run(bad).collect()
    assert {r[0] for r in run(bad, on_error="skip").select("*").collect()} == {
        r[0] for r in run(bad.where("id = 1")).collect()
    }
    assert run(bad, on_error="keep").count() >= 1


def test_message_names_the_bad_row(bad):
    with pytest.raises(Exception, match=r'Row \{"id":2\}'):
        mask(bad.where("id < 3"), "text", ["id"]).collect()


def test_second_answers_end_the_run(spark):
    df = spark.createDataFrame([(1, "x")], "id int, text string")

    def twice(sent):
        one = sent.selectExpr("mapping_id", "masked_prompt AS masked_response")
        return one.unionByName(one)

    with pytest.raises(Exception, match="More than one answer"):
        private_enrich(df, "text", twice, ["id"], model="m").collect()


SECRET = "mail a@x.ru now"


@pytest.mark.parametrize(
    "kind, left",
    [("struct<text:string>", ["id"]), ("struct<text:string,n:int>", ["id", "payload"]),
     ("struct<Text:string,n:int>", ["id", "payload"])],
)
def test_no_raw_text_in_views_and_masked_tables(spark, tmp_path, kind, left):
    values = (1, (SECRET,) if "n:int" not in kind else (SECRET, 5))
    df = spark.createDataFrame([values], f"id int, payload {kind}")
    views = register_views(df, "v", "payload.text", ["id"])
    for view in views:
        if view in ("v_masked", "v_hits"):
            assert SECRET not in str(spark.table(view).collect())
    folders = [str(tmp_path / n) for n in "mv"]
    counts = write_masked(df, *folders, "payload.text", ["id"], stage_path=str(tmp_path / "stage"))
    masked = spark.read.parquet(str(tmp_path / "m"))
    assert masked.columns == [*left, "masked"] and SECRET not in str(masked.collect())
    assert counts == {"masked": 1, "rejected": 0}
    # The staged table, which holds originals, is gone.
    assert sorted(p.name for p in tmp_path.iterdir()) == ["m", "v"]


def test_one_field_structs_in_structs(spark):
    df = spark.createDataFrame([(1, ((SECRET,), 2))], "id int, p struct<q:struct<t:string>,n:int>")
    assert without_text(df, "p.q.t").schema.simpleString() == "struct<id:int,p:struct<n:int>>"
    with pytest.raises(ValueError):
        without_text(df, "p.q.u")


def test_first_original_counts(spark):
    rows_ = [("w", "i", "<A_001>", "A", o, s, s + 1) for o, s in (("late", 9), ("first", 2), ("first", 2))]
    mapping = spark.createDataFrame(
        rows_, "workspace_id string, mapping_id string, placeholder string, category string, original string, "
        "start int, `end` int",
    )
    df = spark.createDataFrame([("<A_001>", "i", "w")], "text string, mapping_id string, w string")
    out = restore_with_mapping(df, mapping, workspace=F.col("w")).first().restored
    assert out.restored_text == "first"


def test_doubles_in_maps_are_audited(spark):
    df = spark.sql(
        "SELECT map('a', 4111111111111111.0D) AS m, map(4111111111111111.0D, array(1.5D)) AS k, "
        "map('a', named_struct('x', 7707083893.0D)) AS s, cast(NULL AS map<string,double>) AS none"
    )
    text = df.select(row_json(df)).first()[0]
    assert json.loads(text) == {
        "m": {"a": 4111111111111111}, "k": {"4111111111111111": [1.5]}, "s": {"a": {"x": 7707083893}}, "none": None,
    }
    found = {f.category: f["count"] for f in row_audit(df).first().pii.found_pii}
    assert found == {"CARD": 2, "INN": 1}
