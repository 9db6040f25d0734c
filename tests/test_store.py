import pytest
from pyspark.sql import functions as F

from lectern.operators import merge, report, search, store
from lectern.schema import CHECKLIST_COLUMNS, checklist_schema


def records(spark, *rows):
    """Valid records with overrides."""
    base = {c: None for c in CHECKLIST_COLUMNS} | {"title": "T", "year": "2020", "ehr_used": True, "ehr_evidence": "n/a", "summary": "S"}
    made = [base | r for r in rows]
    return spark.createDataFrame([tuple(m[c] for c in CHECKLIST_COLUMNS) for m in made], checklist_schema())


@pytest.fixture
def shelf(spark, tmp_path):
    return store.SnapshotStore(spark, str(tmp_path / "store"))


def test_defaults_and_rejects(spark):
    got = store.validated(records(spark, {"pmcid": "12"}, {"pmcid": "13", "title": None}, {"pmcid": "14", "source_format": "doc"})).orderBy("pmcid").collect()
    assert (got[0].pmcid, got[0].key_findings, got[0].confidence, got[0].data_availability, got[0].reject) == ("PMC12", [], "unclear", "not-stated", None)
    assert "title" in got[1].reject and "source_format" in got[2].reject


def test_order_is_by_text(shelf, spark):
    shelf.add(records(spark, {"pmcid": "PMC9", "year": "2019"}, {"pmcid": "PMC10", "year": "2019"}, {"pmcid": "PMC2", "year": "2018"}))
    assert [r.pmcid for r in shelf.list_all().collect()] == ["PMC2", "PMC10", "PMC9"]


def test_add_get_delete(shelf, spark):
    shelf.add(records(spark, {"pmcid": "pmc1"}))
    with pytest.raises(ValueError, match="exists"):
        shelf.add(records(spark, {"pmcid": "1"}))
    with pytest.raises(ValueError, match="title"):
        shelf.add(records(spark, {"pmcid": "2", "title": None}))
    assert shelf.get("1").count() == 1
    assert shelf.delete("1") is True and shelf.delete("1") is False


def test_update_merges_and_validates(shelf, spark):
    shelf.add(records(spark, {"pmcid": "1", "summary": "old", "title": "kept"}))
    shelf.update("1", summary="new", confidence="HIGH", ehr_used="no")
    row = shelf.get("PMC1").first()
    assert (row.summary, row.title, row.confidence, row.ehr_used) == ("new", "kept", "high", False)
    with pytest.raises(KeyError):
        shelf.update("9", summary="x")
    with pytest.raises(ValueError, match="key"):
        shelf.update("1", pmcid="PMC2")
    with pytest.raises(ValueError, match="ehr_used"):
        shelf.update("1", ehr_used="5")


def test_import_counts(shelf, spark):
    two = records(spark, {"pmcid": "1"}, {"pmcid": "2"})
    assert shelf.import_records(two) == (2, 0)
    assert shelf.import_records(records(spark, {"pmcid": "1"}, {"pmcid": "2", "summary": "other"})) == (0, 1)
    again = records(spark, {"pmcid": "2", "summary": "a"}, {"pmcid": "2", "summary": "b"}).withColumn("at", F.when(F.col("summary") == "a", 1).otherwise(2))
    assert shelf.import_records(again, order="at") == (0, 1)
    assert shelf.get("2").first().summary == "b" and shelf.stats()["n"] == 2


def test_only_one_of_two_writers_commits(spark, tmp_path):
    one, two = (store.SnapshotStore(spark, str(tmp_path / "store")) for _ in range(2))
    one.add(records(spark, {"pmcid": "1"}))
    seen = one.version()
    two.commit(records(spark, {"pmcid": "PMC2"}), seen)
    with pytest.raises(store.Conflict):
        one.commit(records(spark, {"pmcid": "PMC3"}), seen)
    assert sorted(r.pmcid for r in one.read().collect()) == ["PMC1", "PMC2"]
    assert [r.pmcid for r in one.read(seen).collect()] == ["PMC1"]


def test_deltas_are_small_and_merged(shelf, spark, tmp_path):
    shelf.COMPACT_AT = 3
    shelf.add(records(spark, *[{"pmcid": str(i), "key_findings": ["a", None]} for i in range(1, 6)]))
    shelf.update("1", summary="one")
    assert len(shelf._parts(shelf.version())) == 2 and spark.read.parquet(f"{shelf.path}/{shelf._parts(shelf.version())[1]}").count() == 1
    shelf.delete("2")
    assert shelf.import_records(records(spark, {"pmcid": "3", "summary": "three"}, {"pmcid": "2", "summary": "back"})) == (1, 1)
    assert len(shelf._parts(shelf.version())) == 1
    assert {r.pmcid: r.summary for r in shelf.read().collect()} == {"PMC1": "one", "PMC2": "back", "PMC3": "three", "PMC4": "S", "PMC5": "S"}
    assert shelf.read().columns == CHECKLIST_COLUMNS


def test_export_to_two_places(shelf, spark, tmp_path):
    shelf.add(records(spark, {"pmcid": "2", "model": "m"}, {"pmcid": "1", "model": "m"}))
    assert shelf.export(str(tmp_path / "a"), str(tmp_path / "b")) == 2
    from lectern.sources import files

    assert [r.pmcid for r in files.read_batch(spark, str(tmp_path / "a")).collect()] == [r.pmcid for r in files.read_batch(spark, str(tmp_path / "b")).collect()] == ["PMC1", "PMC2"]


def test_insert_refuses_known_keys(spark):
    base = spark.createDataFrame([("a", 1)], "k string, v int")
    assert store.insert(base, spark.createDataFrame([("b", 2)], "k string, v int"), "k").count() == 2
    with pytest.raises(Exception, match="already exists"):
        store.insert(base, base, "k").collect()


def test_find(spark):
    df = records(spark, {"pmcid": "PMC1", "ehr_used": True, "pathologies_diseases": ["Asthma", None]}, {"pmcid": "PMC2", "ehr_used": False, "exposure_domain": "Lead"}, {"pmcid": "PMC3", "title": "On vaccines", "ehr_used": None})
    ids = lambda **f: [r.pmcid for r in search.find(df, **f).collect()]
    assert ids(ehr_used=True) == ["PMC1"] and ids(ehr_used=False) == ["PMC2", "PMC3"]
    assert ids(disease="asthma") == ["PMC1"] and ids(exposure="LEAD") == ["PMC2"] and ids(query="vacc") == ["PMC3"]
    assert ids() == ["PMC1", "PMC2", "PMC3"] and ids(disease="asthma", exposure="lead") == []
    box = lambda q: [r.pmcid for r in search.web_search(df, q).collect()]
    assert box("Vaccine ") == ["PMC3"] and box("ehr") == ["PMC1"] and box("lead") == ["PMC2"] and len(box("  ")) == 3
    assert [r.pmcid for r in search.select_keys(df, ["3", "pmc1"], 1).collect()] == ["PMC1"]


def test_patch_takes_present_nulls(spark):
    base = spark.createDataFrame([("a", "x", "y")], "k string, p string, q string")
    change = spark.createDataFrame([("a", None, "z", ["p"])], "k string, p string, q string, present array<string>")
    assert merge.patch(base, change, "k", ["p", "q"]).first()[:] == ("a", None, "y")


def test_chunks_merge(spark):
    ddl = "k string, i int, e string, flag boolean, t string, l array<string>, c string"
    parts = spark.createDataFrame([("a", 1, "n/a", False, "", ["x", "y"], "low"), ("a", 2, "seen", True, "first", ["y", " z "], "HIGH"), ("a", 3, "again", None, "second", None, "odd"), ("b", 1, None, None, None, None, None)], ddl)
    got = {r.k: r for r in merge.merge_chunks(parts, "k", "i", flag="flag", evidence="e", texts=["t"], lists=["l"], confidence="c").collect()}
    assert got["a"][1:] == (True, "seen again", "first", ["x", "y", "z"], "high")
    assert got["b"][1:] == (False, "n/a", "", [], "unclear")
    many = spark.range(1, 3001).selectExpr("'h' as k", "int(id) as i", "concat('e', id) as e", "false as flag", "'' as t", "array(concat('v', id % 7), null) as l", "'low' as c")
    hot = merge.merge_chunks(many, "k", "i", flag="flag", evidence="e", texts=["t"], lists=["l"], confidence="c").first()
    assert hot.e == " ".join(f"e{i}" for i in range(1, 300))[:500] and hot.l == [f"v{i % 7}" for i in range(1, 8)]


def test_links_make_data_public(spark):
    rows = spark.createDataFrame([(["A"], "in-house", "s", "see GSE12345"), (None, None, None, "deposited as GSE99999"), (["A"], "in-house", "s", "none")], "l array<string>, a string, s string, w string")
    got = [r[0] for r in rows.select(merge.with_links_found(F.col("l"), F.col("a"), F.col("s"), F.col("w"))).collect()]
    assert got[0][:] == ("public-repository", ["A", "GSE12345"], "s")
    assert got[1][:] == ("public-repository", ["GSE99999"], "deposited as GSE99999")
    assert got[2][:] == ("in-house", ["A"], "s")


def test_reports_of_no_rows(spark):
    none = records(spark).limit(0)
    assert report.headline(none).first()[:] == (0, 0, 0, None)
    assert report.span(none, "year").first()[:] == ("", "", 0)
    assert store.most_common(none, "model", ["year", "pmcid"]).first()[0] == ""
    assert report.numbered(none, ["year", "pmcid"]).count() == 0


def test_first_seen_breaks_ties(spark):
    df = records(spark, {"pmcid": "PMC2", "pathologies_diseases": ["b", "A "]}, {"pmcid": "PMC1", "pathologies_diseases": ["a", "c"]})
    assert [tuple(r) for r in report.top_first_seen(df, F.col("pathologies_diseases"), 3, ["year", "pmcid"]).collect()] == [("a", 2), ("c", 1), ("b", 1)]


def test_numbers_are_gapless(spark):
    numbered = report.numbered(spark.range(1000).repartition(7), ["id"])
    assert numbered.filter("no <> id + 1").count() == 0 and numbered.count() == 1000


def test_summary_markdown(spark):
    text = report.summary_markdown(records(spark, {"pmcid": "PMC1", "pathologies_diseases": ["asthma"], "confidence": "high"}))
    assert "| PMC1 | 2020 | asthma | — | T |" in text
    assert report.console_table(spark.createDataFrame([(1, None), (22, "b")], "a int, bb string"), 1) == "a  bb\n-  --\n1\nmore rows follow"
    assert "| asthma | 1 |" in text and "| high | 1 |" in text and "1 of 1 (100%)" in text


def test_envelope(spark, tmp_path):
    import json

    text = lambda df: "\n".join(r.line for r in store.envelope(df).orderBy("place").collect())
    made = json.loads(text(records(spark, {"pmcid": "PMC2", "model": "m", "title": 'a"b'}, {"pmcid": "PMC1", "model": "m"})))
    assert (made["n"], made["model"], [x["pmcid"] for x in made["summaries"]], made["summaries"][1]["title"]) == (2, "m", ["PMC1", "PMC2"], 'a"b')
    assert set(made["summaries"][0]) == set(CHECKLIST_COLUMNS)
    assert json.loads(text(records(spark).limit(0))) == {"n": 0, "model": "", "summaries": []}
    store.write_envelope(store.envelope(records(spark, *[{"pmcid": f"PMC{i:04}"} for i in range(500)])), str(tmp_path / "b"))
    (part,) = (tmp_path / "b").glob("part-*")
    assert [x["pmcid"] for x in json.loads(part.read_text())["summaries"]] == [f"PMC{i:04}" for i in range(500)]
