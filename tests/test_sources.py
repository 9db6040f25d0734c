import io
import json
import tarfile

import pytest
from pyspark.sql import functions as F

from lectern.plans import availability, extraction
from lectern.plans.pipeline import Pipeline, observed
from lectern.schema import CHECKLIST_COLUMNS
from lectern.sources import files, fulltext, remote

ARTICLE = """<article><front><article-title>Lead and growth</article-title><abstract>Short.</abstract></front>
<body><sec><title>Data availability</title>On request.</sec>{body}</body></article>"""


def record(pmcid, **more):
    return {"pmcid": pmcid, "title": "T", "year": "2020", "ehr_used": True, "ehr_evidence": "n/a", "summary": "S", "key_findings": ["k"]} | more


def test_record_files(spark, tmp_path):
    (tmp_path / "PMC1.json").write_text(json.dumps(record("PMC1"), indent=2))
    (tmp_path / "PMC_BAD.json").write_text("{broken")
    (tmp_path / "README.txt").write_text("ignored")
    rows = files.read_records(spark, str(tmp_path))
    assert rows.filter("_corrupt_record is null").first().pmcid == "PMC1"
    assert files.parse_failures(rows).first()[:] == (1, 1)


def test_batch_as_envelope_or_list(spark, tmp_path):
    path = tmp_path / "a.json"
    path.write_text(json.dumps({"n": 1, "model": "m", "summaries": [record("PMC1")]}, indent=1))
    assert [r.pmcid for r in files.read_batch(spark, str(path)).collect()] == ["PMC1"]
    path.write_text(json.dumps([record("PMC2"), record("PMC3")]))
    assert files.read_batch(spark, str(path)).count() == 2
    files.write_batch(files.read_batch(spark, str(path)).select(*CHECKLIST_COLUMNS), str(tmp_path / "out"))
    assert files.read_batch(spark, str(tmp_path / "out")).count() == 2


def test_log_lists(spark, tmp_path):
    path = tmp_path / "log.json"
    path.write_text(json.dumps({"papers": [{"pmcid": "PMC1", "title": "t"}], "downloaded": ["1"], "xml_only": ["PMC1"]}))
    log = files.read_log(spark, str(path))
    assert log["papers"].first().title == "t" and log["downloaded"].first().uid == "1" and log["failed"].count() == 0
    path.write_text("")
    assert files.read_log(spark, str(path))["papers"].count() == 0


def test_metadata_keeps_the_last_of_repeats(spark, tmp_path):
    (tmp_path / "m.json").write_text("\n".join(json.dumps({"uid": "1", "title": t}) for t in "ab"))
    assert [r.title for r in files.read_metadata(spark, str(tmp_path)).collect()] == ["b"]


def test_discover_and_split(spark, tmp_path):
    for name in ("2020_PMC2_x.pdf", "2020_PMC1_x.xml", "notes.txt"):
        (tmp_path / name).write_bytes(b"x")
    assert [(r.pmcid, r.format) for r in files.discover(spark, str(tmp_path)).collect()] == [("PMC1", "xml"), ("PMC2", "pdf")]
    seen = {}
    files.split_write(spark.range(4).withColumn("v", F.nullif("id", F.lit(3))), F.col("v") > 1, lambda d: seen.update(kept=d.count()), lambda d: seen.update(dropped=d.count()))
    assert seen == {"kept": 1, "dropped": 3}
    assert files.one_record({"a": 1, "b": 1}, {"b": 2}, {"b": None, "c": 3}) == {"a": 1, "b": 2, "c": 3}


def test_jats():
    text = fulltext.jats_text(ARTICLE.format(body="Body text.").encode(), "stem")
    assert text.startswith("Lead and growth\n\nShort.\n\n") and text.count("On request.") == 2
    assert fulltext.jats_text(b"<broken", "stem") == "stem" and fulltext.jats_text(None, "stem") == "stem"


def test_validation(spark):
    body = ARTICLE.format(body="w" * 2500).encode()
    rows = [("a.pdf", b"%PDF-" + b"x" * 20_000), ("b.pdf", b"%PDF-"), ("c.pdf", b"x" * 30_000), ("d.xml", body), ("e.xml", body.replace(b"<article>", b'<article article-type="abstract">')), ("f.xml", b"<no"), ("g.xml", None)]
    df = spark.createDataFrame(rows, "path string, content binary")
    assert [r.path for r in df.filter(fulltext.valid_fulltext(F.col("content"), F.col("path"))).orderBy("path").collect()] == ["a.pdf", "d.xml"]


def test_extract_with_and_without_a_pdf_reader(spark):
    df = spark.createDataFrame([("a.pdf", b"ab"), ("b.txt", b"plain \xff"), ("c.xml", b"<a")], "path string, content binary")

    def pages(data):
        def fail():
            raise ValueError

        return [lambda: data.decode(), fail, lambda: "end"]

    assert {r.path: r.text for r in fulltext.extract(df, pages).collect()} == {"a.pdf": "ab\nend", "b.txt": "plain ", "c.xml": "c"}
    assert {r.path: r.text for r in fulltext.extract(df).collect()}["a.pdf"] is None


def test_archives(spark):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w:gz") as archive:
        for name, size in (("p/main.pdf", 50), ("p/supp1.pdf", 900), ("p/data.csv", 99)):
            info = tarfile.TarInfo(name)
            info.size = size
            archive.addfile(info, io.BytesIO(b"x" * size))
    df = spark.createDataFrame([("a", out.getvalue()), ("b", b"broken"), ("c", None)], "path string, content binary")
    assert [tuple(r) for r in fulltext.main_member(fulltext.archive_members(df)).collect()] == [("a", "p/main.pdf", 50)]


def test_links(spark):
    body = '<r><link format="pdf" href="ftp://a/1.pdf"/><link format="pdf" href="ftp://a/2.pdf"/></r>'
    got = spark.createDataFrame([(body,), ("<",), (None,)], "b string").select(fulltext.links_of("b").alias("l")).collect()
    assert [r.l[:] for r in got] == [("https://a/2.pdf", None), (None, None), (None, None)]
    urls = spark.createDataFrame([([("html", "x"), ("PDF", "y")],), ([],), (None,)], "u array<struct<documentStyle:string,url:string>>")
    assert [r[0] for r in urls.select(fulltext.pdf_address(F.col("u"))).collect()] == ["y", None, None]


def test_cascade_asks_only_for_what_is_open(spark):
    asked = []

    def source(name, known):
        def ask(keys):
            asked.append((name, sorted(r.k for r in keys.collect())))
            return keys.select("k", F.when(F.col("k").isin(known), F.concat(F.lit(name), "k")).alias("value"))

        return name, ask

    keys = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    got = {r.k: (r.found_by, r.value) for r in fulltext.cascade(keys, "k", [source("x", ["a"]), source("y", ["a", "b"])]).collect()}
    assert got == {"a": ("x", "xa"), "b": ("y", "yb"), "c": (None, None)} and asked == [("x", ["a", "b", "c"]), ("y", ["b", "c"])]


def test_search_source(spark):
    def client(query, most):
        if query == "fails":
            raise OSError
        return 500, [f"{query}{i}" for i in range(most)]

    spark.dataSource.register(remote.search_source("papers", client, max_hits=3))
    got = spark.read.format("papers").option("queries", "a\nfails\nb").load()
    assert got.count() == 6 and got.filter("capped").count() == 6 and got.select("uid").distinct().count() == 6


def test_lookup_and_download(spark):
    ids = spark.createDataFrame([(str(i),) for i in range(45)], "uid string")
    found = remote.lookup(ids, lambda keys: {k: {"title": f"{k} of {len(keys)}"} for k in keys if k != "7"}, "uid string, title string", delay=0, tasks=1)
    assert found.count() == 44 and found.filter("title like '% of 20'").count() >= 39
    urls = spark.createDataFrame([("a", "big"), ("b", "small"), ("c", "gone"), ("d", None)], "pmcid string, url string")
    size = {"big": 6000, "small": 10}
    got = remote.download(urls, lambda u: (200, b"x" * size[u]), delay=0)
    assert {r.pmcid: r.content is not None for r in got.collect()} == {"a": True, "b": False, "c": False, "d": False}


def test_ask_tells_errors_back():
    replies = iter(["nonsense", '{"a": 1}', '{"b": 2}'])
    heard = []

    def client(messages):
        heard.append(len(messages))
        return next(replies)

    assert extraction.ask(client, "s", "u", lambda x: None if "b" in x else "missing b", pause=0) == {"b": 2} and heard == [2, 4, 6]

    def broken(messages):
        raise OSError("down")

    with pytest.raises(RuntimeError, match="down"):
        extraction.ask(broken, "s", "u", lambda x: None, pause=0)


def test_extraction_by_pieces(spark):
    papers = spark.createDataFrame([("PMC1", "t", "2020", "x" * 5000), ("PMC2", "bad", "2020", "y")], "pmcid string, title string, year string, text string")

    def client(messages):
        if "Title: bad" in messages[1]["content"]:
            return "no"
        return json.dumps({"ehr_used": "No", "summary": "s", "key_findings": ["f"], "confidence": "low"})

    results = extraction.extract(extraction.chunked(papers), client, "system", ["summary"], pause=0).cache()
    assert {r.status: r.n for r in extraction.tallies(results).collect()} == {"ok": 2, "failed": 1}
    row = extraction.merged(results).first()
    assert (row.pmcid, row.ehr_used, row.summary, row.key_findings, row.confidence) == ("PMC1", False, "s", ["f"], "low")
    assert [r.pmcid for r in extraction.to_do(papers, results.filter("status = 'ok'")).collect()] == ["PMC2"]
    assert extraction.whole(papers).count() == 2


def test_pipeline_edges_are_parameter_names(spark):
    line = Pipeline()

    @line.stage
    def doubled(numbers):
        return numbers.selectExpr("id * 2 as id")

    @line.stage
    def joined(numbers, doubled):
        return numbers.join(doubled, "id")

    assert line.order() == ["doubled", "joined"] and line.upstream("joined") == ["numbers", "doubled"]
    frames = line.run(numbers=spark.range(4))
    assert sorted(r.id for r in frames["joined"].collect()) == [0, 2]
    with pytest.raises(KeyError):
        line.run()
    df, watch = observed(spark.range(5), "rows of five")
    df.collect()
    assert watch.get == {"rows": 5}


def test_availability_scan(spark):
    texts = {
        "PMC1": "Methods. Data availability: deposited as GSE12345 in GEO.",
        "PMC2": "Data availability: on request.",
        "PMC3": "Nothing here.",
        "PMC4": "See https://zenodo.org/records/77 for all files.",
        "PMC5": None,
        "PMC6": "Code availability: in house.",
    }
    said = {
        "PMC1": '```json\n{"data_availability": "available upon request", "data_accession_links": "phs000123", "data_availability_statement": "s"}\n```',
        "PMC2": '{"data_availability": "available_upon_request", "data_accession_links": ["", " x "]}',
        "PMC3": "data_availability: not stated",
        "PMC6": "no idea",
    }
    asked = spark.sparkContext.accumulator(0)

    def client(messages):
        asked.add(1)
        key = messages[1]["content"].split("PMCID: ")[1][:4]
        return said[key]

    papers = spark.createDataFrame([(k, "t", "2020", v) for k, v in texts.items()], "pmcid string, title string, year string, text string")
    found = availability.scan(papers, client)
    got = {r.pmcid: r[1:] for r in found.collect()}
    assert got == {
        "PMC1": ("public-repository", ["phs000123", "GSE12345"], "s", "both"),
        "PMC2": ("available-upon-request", ["x"], "", "model"),
        "PMC3": ("not-stated", [], "", "model"),
        "PMC4": ("public-repository", ["https://zenodo.org/records/77"], "Data deposited in a public repository.", "patterns"),
        "PMC5": (None, None, None, "none"),
        "PMC6": (None, None, None, "none"),
    }
    # one call a paper with a text, the failing one for PMC4 included
    assert asked.value == 5
    records = spark.createDataFrame([("PMC1", "kept", "in-house", None, None), ("PMC6", "kept", "in-house", ["a"], "b"), ("PMC9", "kept", None, None, None)], "pmcid string, summary string, data_availability string, data_accession_links array<string>, data_availability_statement string")
    merged = {r.pmcid: r[1:] for r in availability.scanned_records(records, found).collect()}
    assert merged["PMC1"] == ("kept", "public-repository", ["phs000123", "GSE12345"], "s") and merged["PMC6"] == ("kept", "in-house", ["a"], "b")
    assert merged["PMC4"][0] is None and merged["PMC4"][1] == "public-repository" and merged["PMC9"] == ("kept", None, None, None) and len(merged) == 6
    alone = {r.pmcid: r.told_by for r in availability.scan(papers).collect()}
    assert alone == {"PMC1": "patterns", "PMC4": "patterns", "PMC2": "none", "PMC3": "none", "PMC5": "none", "PMC6": "none"}
    assert availability.scan(papers.limit(0), client).count() == 0


def test_model_settings():
    assert extraction.settings({"LECTERN_MODEL_KEY": " k ", "LECTERN_MODEL_URL": " "}) == {**extraction.DEFAULTS, "key": "k"}
    assert extraction.settings({"LECTERN_MODEL_KEY": "k", "LECTERN_MODEL_MODEL": "m"})["model"] == "m"
    with pytest.raises(RuntimeError, match="KEY"):
        extraction.settings({"LECTERN_MODEL_KEY": " "})


def test_record_buckets(spark, tmp_path):
    rows = spark.createDataFrame([(f"PMC{i}", "t\nu", None if i % 2 else "2020", True, None, "s", ["a", None], [], None, *[None] * 11) for i in range(50)], files.checklist_schema())
    files.write_records(rows, str(tmp_path / "out"), buckets=4)
    assert len(list((tmp_path / "out").glob("bucket=*"))) == 4
    assert {tuple(map(str, r)) for r in files.read_record_lines(spark, str(tmp_path / "out")).collect()} == {tuple(map(str, r)) for r in rows.collect()}
