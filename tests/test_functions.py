from pyspark.sql import functions as F

from lectern.functions import coerce, jsonfix, rules
from lectern.functions import text as tx


def one(spark, column, **values):
    """The value of a column expression over one row of text columns."""
    ddl = ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], ddl).select(column.alias("x")).first()[0]


def test_ids(spark):
    for text, want in (("7654321", "PMC7654321"), (" pmc12 ", "PMC12"), ("PMC1\n", "PMC1"), (None, None)):
        assert one(spark, coerce.pmcid(F.col("a")), a=text) == want


def test_boolean_words(spark):
    for text, want in (("Yes", True), (" used ", True), ("not used", False), ("0", False), ("5", None), (None, None)):
        assert one(spark, coerce.boolean(F.col("a")), a=text) is want


def test_categories(spark):
    for text, want in (("available upon request", "available-upon-request"), ("public_repository", "public-repository"), ("maybe", "not-stated"), (None, "not-stated")):
        assert one(spark, coerce.availability(F.col("a")), a=text) == want
    assert one(spark, coerce.availability(F.col("a"), None), a="maybe") is None
    assert one(spark, coerce.confidence(F.col("a")), a=" HIGH") == "high"
    assert one(spark, coerce.confidence(F.col("a")), a=None) == "unclear"


def test_lists(spark):
    assert one(spark, coerce.list_of(F.col("a")), a=["GSE12345", "", "  ", None, " x "]) == ["GSE12345", "x"]
    assert one(spark, coerce.list_of_text(F.col("a")), a=" GSE ") == [" GSE "]
    assert one(spark, coerce.list_of_text(F.col("a")), a="  ") == []
    for text, want in (('"GSE12345"', ["GSE12345"]), ('["a", "", " b"]', ["a", "b"]), ("null", [])):
        assert one(spark, coerce.list_of_variant(F.parse_json("a")), a=text) == want


def test_clip(spark):
    clip = lambda text, n=10: one(spark, tx.clip(F.col("a"), n), a=text)
    assert clip("short") == "short"
    assert clip("") == "—"
    assert clip("a|b") == "a/b"
    assert clip("one two three") == "one two…"
    assert clip("abcdefghijklm") == "abcdefghij…"
    assert clip("one, two, three", 9) == "one…"


def test_paths_and_stems(spark):
    assert one(spark, tx.pmcid_in_path(F.col("a")), a="/x/2020_PMC7145790_a.b.pdf") == "PMC7145790"
    assert one(spark, tx.pmcid_in_path(F.col("a")), a="/x/notes.pdf") == "notes"
    assert one(spark, tx.file_stem(F.col("a")), a=" A study: of (things) \n here") == "A_study_of_things_here"
    assert one(spark, tx.https(F.col("a")), a="ftp://h/ftp://x") == "https://h/ftp://x"


def test_wrapped_address(spark):
    text = "at https://github.com/lab/early-life-sugar -\nrationing-health now"
    assert one(spark, tx.accession_links(F.col("a")), a=text) == ["https://github.com/lab/early-life-sugar-rationing-health"]
    assert one(spark, tx.unwrap(F.col("a")), a="a-\nb-\nc") == "a-bc"


def test_accessions_in_order_of_pattern(spark):
    text = "GSE12345, ENA: PRJEB9999 and dbGaP phs000123.v1.p1, again GSE12345"
    assert one(spark, tx.accession_links(F.col("a")), a=text) == ["phs000123.v1.p1", "GSE12345", "PRJEB9999", "ENA: PRJEB9999"]


def test_window(spark):
    text = "x" * 500 + "Data availability: here" + "y" * 7000
    window = one(spark, tx.availability_window(F.col("a")), a=text)
    assert len(window) == 6000 and window.startswith("x" * 200 + "Data availability")
    assert one(spark, tx.availability_window(F.col("a")), a="z" * 7000) == "z" * 6000


def test_chunks_cover_the_text(spark):
    text = "".join(chr(97 + i % 26) for i in range(9000))
    parts = one(spark, tx.chunks(F.col("a")), a=text)
    assert [len(p) for p in parts] == [4000, 4000, 2200] and parts[1] == text[3400:7400]
    assert one(spark, tx.chunks(F.col("a")), a="  tiny ") == ["tiny"]


def test_percent_rounds_half_to_even(spark):
    assert spark.range(1).select(tx.percent(F.lit(1), F.lit(8)), tx.percent(F.lit(0), F.lit(0))).first()[:] == (12.5, 0.0)


def test_template_and_html(spark):
    assert one(spark, tx.fill_template(F.lit("a %%B%% %%C%%"), {"B": F.col("a"), "C": F.lit("z")}), a="x") == "a x z"
    assert one(spark, tx.escape_html(F.col("a")), a="<a&'\">") == "&lt;a&amp;&#x27;&quot;&gt;"


def test_quoted_statements(spark):
    text = '"too short" "The data are available on request." "no such words in this sentence here"'
    assert one(spark, tx.quoted_statements(F.col("a")), a=text) == "The data are available on request."


def test_salvage():
    assert jsonfix.salvage('x ```json\n{"a": 1}\n``` y') == {"a": 1}
    assert jsonfix.salvage('noise {"a": {"b": 1}} trailing') == {"a": {"b": 1}}
    assert jsonfix.salvage('{"a": 1} {"a": 2, "b": 3}') == {"a": 2, "b": 3}
    assert jsonfix.salvage('{"a": {"b": 1}') == {"a": {"b": 1}}
    assert jsonfix.salvage('{"a": 1,') == {"a": 1}
    assert jsonfix.salvage("garbage") is None and jsonfix.salvage(None) is None


def test_prose_reply(spark):
    text = '* `data_availability`: "not stated"\n* `data_availability`: in-house\n'
    assert one(spark, jsonfix.availability_reply(F.col("a")), a=text).data_availability == "in-house"
    lifted = one(spark, jsonfix.availability_reply(F.col("a")), a='see GSE12345 "The data were deposited in GEO now."')
    assert lifted[:] == ("public-repository", ["GSE12345"], "The data were deposited in GEO now.")
    assert one(spark, jsonfix.availability_reply(F.col("a")), a="nothing") is None


def test_buckets_take_the_first_label(spark):
    bucket = lambda t: one(spark, rules.first_bucket(F.col("a"), rules.EXPOSURE_BUCKETS), a=t)
    assert bucket("Prenatal smoking") == "Air pollution"
    assert bucket("Smoking cessation") == "Other / mixed"
    assert bucket("DDT") == "Other / mixed"
    assert bucket(None) == "Other / mixed"


def test_routes(spark):
    route = lambda t, j=None, p=None: one(spark, rules.route(F.col("t"), F.col("j"), F.col("p")), t=t, j=j, p=p)
    assert route("A scoping review") == "review"
    assert route("X", p="Journal Article Review") == "review"
    assert route("Histone marks") == "epigenome"
    assert route("Exposome and methylation") == "ok"
    assert route("P-12. Title") == "conference"
    assert route("X", j="Innov Aging") == "conference"
    assert route(None) == "ok"


def test_searches(spark):
    rows = spark.createDataFrame([(1, "Exposome of children", "risk in a cohort"), (2, "Exposome of adults", "risk"), (3, "Exposome of children", "risk; a protocol"), (4, None, None)], "id int, t string, b string")
    assert {r.id: r.tiers for r in rules.with_tiers(rows, "t", "b").collect()} == {1: [1, 4], 2: [], 3: [], 4: []}


def test_replies_are_salvaged(spark):
    replies = [
        ('Sure:\n```json\n{"a": 1, "b": ["x"]}\n```\nDone.', '{"a": 1, "b": ["x"]}'),
        ('noise {"a": 2} trailing', '{"a": 2}'),
        ("garbage", None),
        ('{"a": 1} and {"a": 3, "b": 4}', '{"a": 3, "b": 4}'),
        ('{"a": {"b": 5}', '{"a": {"b": 5}}'),
        ('{"a": 6, "b": "cut', None),
        (None, None),
        ("", None),
    ]
    df = spark.createDataFrame([(i, r) for i, (r, _) in enumerate(replies)], "id int, reply string")
    got = {r.id: r.found for r in df.select("id", jsonfix.salvaged_json("reply").alias("found")).collect()}
    assert [got[i] for i in range(len(replies))] == [want for _, want in replies]


def test_fixture_operators_run_over_their_tables(spark, data):
    import json

    from lectern.plans import catalogue
    from lectern.session import read_table

    run = lambda name: catalogue.queries()[name](spark, data)
    payloads = {r.raw_id: r.payload for r in read_table(spark, data, "raw_checklists").collect()}
    got = run("json_salvage").collect()
    assert len(got) == read_table(spark, data, "raw_checklists").count()
    assert all(r.found == json.dumps(jsonfix.salvage(payloads[r.id]), ensure_ascii=False, sort_keys=True) for r in got if r.found is not None)
    assert run("wrap_repair_documents").count() == read_table(spark, data, "documents").count()
    assert run("clip_summaries").count() == read_table(spark, data, "checklists").count()
