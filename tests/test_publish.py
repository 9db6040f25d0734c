import json
import sys
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
from test_store import records  # noqa: E402

from lectern.operators import publish, store  # noqa: E402
from lectern.sources import files  # noqa: E402


def test_page(spark):
    df = records(spark, {"pmcid": "PMC2", "year": "2021", "title": "a </script> b"}, {"pmcid": "PMC1", "year": ""})
    text = lambda rows, template: "".join(r.line for r in publish.site_page(rows, template).orderBy("place").collect())
    page = text(df, "%%COUNT%%|%%FIRST%%|%%LAST%%|%%DATA%%")
    count, first, last, data = page.split("|", 3)
    assert (count, first, last) == ("2", "2021", "2021") and "</script>" not in data
    assert [r["pmcid"] for r in json.loads(data)] == ["PMC1", "PMC2"] and json.loads(data)[1]["title"] == "a </script> b"
    assert text(df.limit(0), "%%COUNT%%%%DATA%%.") == "0[]."
    assert publish.site_records(df.drop("summary")).first().summary is None


def test_merged_list_keeps_the_first_place(spark):
    a = spark.createDataFrame([("x", 1), ("y", None), ("x", 1)], "k string, v int").coalesce(1)
    b = spark.createDataFrame([("z", 3), ("y", None), ("x", 2)], "k string, v int").coalesce(1)
    assert [tuple(r) for r in publish.merged_list(a, b).collect()] == [("x", 1), ("y", None), ("z", 3), ("x", 2)]


def test_rebuild_skips_what_is_bad(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    good = {"pmcid": "PMC1", "title": "T", "year": "2020", "ehr_used": True, "ehr_evidence": "n/a", "summary": "S"}
    (folder / "a.json").write_text(json.dumps(good))
    (folder / "b.json").write_text("{broken")
    (folder / "c.json").write_text(json.dumps({**good, "pmcid": "PMC2", "title": None}))
    shelf = store.SnapshotStore(spark, str(tmp_path / "store"))
    assert publish.rebuild(shelf, files.read_records(spark, str(folder))) == (1, 0, 2)
    (folder / "a.json").unlink()
    (folder / "d.json").write_text(json.dumps({**good, "pmcid": "PMC3"}))
    assert publish.rebuild(shelf, files.read_records(spark, str(folder)))[0] == 1 and shelf.read().count() == 2
    assert publish.changed(shelf.read(), shelf.read().withColumn("summary", F.lit("other")), "pmcid").count() == 2


def test_small_columns(spark):
    rows = spark.createDataFrame([("http://h/search?q=lead%20dust&x=1", ["a", "b"]), ("http://h/", [])], "u string, p array<string>")
    got = [tuple(r) for r in rows.select(publish.search_words(F.col("u")), publish.has_all(F.col("p"), ["a"])).collect()]
    assert got == [("lead dust", True), ("", False)]


def test_the_inventory_document(spark, tmp_path):
    papers = spark.createDataFrame([("PMC2", "2021", "J|x", "Lead and asthma"), ("PMC1", "2019", None, "Nothing"), ("PMC3", "", "K", "Air pollution")], "pmcid string, year string, journal string, title string")
    lines = publish.paper_summary(papers, papers.filter("pmcid = 'PMC1'"), abstract_only=1, excluded=2)
    text = [r.line for r in lines.orderBy("section", "place").collect()]
    assert text[2] == "> 3 papers: 2 PDF, 1 XML, 2019–2021; 1 abstracts only, 2 excluded." and "| 1 | PMC3 |  | K | Air pollution | Air pollution | Other / mixed | PDF |" in text
    assert "| Metals / lead | 1 | PMC2 |" in text and "| Respiratory | 1 | PMC2 |" in text
    publish.write_lines(lines, str(tmp_path / "doc"))
    written = "".join(p.read_text() for p in sorted((tmp_path / "doc").glob("part-*")))
    assert written.splitlines() == text
    assert publish.paper_summary(papers.limit(0), papers).filter("section = 1").count() == 3


def test_outcomes_and_merged_keys(spark):
    tries = [("1", "PMC1", "a", "xml", True, True), ("2", "PMC2", "b", "pdf", True, True), ("3", "PMC3", "c", "pdf", True, False), ("4", "PMC4", None, None, None, None)]
    df = spark.createDataFrame(tries, "uid string, pmcid string, title string, format string, found boolean, genuine boolean")
    got = sorted((r.list, r.uid) for r in publish.outcomes(df).collect())
    assert got == [("abstract_only", "3"), ("downloaded", "1"), ("downloaded", "2"), ("failed", "4"), ("xml_only", "1")]
    maps = spark.createDataFrame([({"a": "1", "b": "2"}, {"b": None, "c": "3"})], "x map<string,string>, y map<string,string>")
    assert maps.select(publish.merged_keys(F.col("x"), F.col("y"))).first()[0] == {"a": "1", "b": None, "c": "3"}
