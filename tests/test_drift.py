import json
from datetime import datetime

from lectern.operators import drift
from lectern.operators.skew import lookup
from lectern.schema import CHECKLIST_COLUMNS, CHECKLIST_TYPES

DDL = "raw_id long, stream string, file_name string, pos int, exported_at timestamp_ntz, payload string"


def raw(spark, *given):
    """Files (stream, name, day, payloads), payloads as objects or as they stand."""
    rows, n = [], 0
    for stream, name, day, payloads in given:
        for pos, p in enumerate(payloads):
            n += 1
            rows.append((n, stream, name, pos, datetime(2021, 1, day), p if p is None or isinstance(p, str) else json.dumps(p)))
    return spark.createDataFrame(rows, DDL)


def changes(spark, *given):
    return sorted((r.file, r.field, r.change) for r in drift.changes(raw(spark, *given), CHECKLIST_COLUMNS).collect())


def test_every_kind_of_change(spark):
    got = changes(
        spark,
        ("s", "b", 2, [{"modelName": ["x"], "year": 2020, "licence": "open"}]),
        ("s", "a", 1, [{"model": "x", "year": "2020", "links": []}]),
        ("s", "c", 3, [{"modelName": ["x"], "year": 2020, "licence": "open"}]),
    )
    assert got == [("b", "data_accession_links", "removed"), ("b", "licence", "added"), ("b", "model", "renamed"), ("b", "model", "retyped"), ("b", "year", "retyped")]


def test_nulls_and_empty_lists_show_no_type(spark):
    assert changes(spark, ("s", "a", 1, [{"links": None, "year": "1"}]), ("s", "b", 2, [{"links": ["x"], "year": None}]), ("s", "c", 3, [{"links": [], "year": 5}])) == []


def test_types(spark):
    shown = {"a": 1, "b": 1.5, "c": True, "d": {"x": [1]}, "e": ["x"], "f": [{"y": 1}], "g": [[1], []], "h": None, "i": [None], "j": "t", "k": 2.0}
    got = {r.key: r.json_type for r in drift.footers(raw(spark, ("s", "f", 1, [shown]))).collect()}
    assert got == {"a": "whole", "b": "fraction", "c": "boolean", "d": "object", "e": "array<string>", "f": "array<object>", "g": "array<array<whole>>", "h": None, "i": None, "j": "string", "k": "fraction"}


def test_damaged_payloads_are_not_read(spark):
    assert changes(spark, ("s", "a", 1, [{"year": "1"}, '{"licence": "x', "", None, "[1]", '{"a": 1} tail']), ("s", "b", 2, [{"year": "1"}])) == []


def test_streams_are_apart_and_the_first_file_reports_nothing(spark):
    assert changes(spark, ("s", "a", 1, [{"year": "1"}]), ("t", "b", 2, [{"licence": "1"}]), (None, "c", 3, [{"x": 1}]), (None, "d", 4, [{"y": 1}])) == [("d", "x", "removed"), ("d", "y", "added")]
    assert changes(spark) == []


def test_spellings_of_a_column_are_one_field(spark):
    assert changes(spark, ("s", "a", 1, [{"ehrUsed": True}]), ("s", "b", 2, [{"EHR-used": True}]), ("s", "c", 3, [{"uses_ehr": 1}])) == [("b", "ehr_used", "renamed"), ("c", "ehr_used", "renamed"), ("c", "ehr_used", "retyped")]


def test_keys_of_the_test_tables():
    known = drift.known_keys(CHECKLIST_COLUMNS)
    wanted = {"confidence_level": "confidence", "modelName": "model", "llm": "model", "Data_Availability": "data_availability", "da_category": "data_availability", "accession_links": "data_accession_links", "diseases": "pathologies_diseases", "title": "title"}
    assert {k: known[drift.bare(k)] for k in wanted} == wanted
    assert not {"licence", "secondreader", "reviewstate", "prompttokens", "batchcost"} & set(known)


def test_many_files_are_numbered_in_order(spark):
    import random

    days = [(f"f{i:03}", i) for i in range(300)]
    random.Random(1).shuffle(days)
    rows = [(i, "hot" if i % 3 else "cold", n, 0, datetime.fromordinal(738000 + d), "{}") for i, (n, d) in enumerate(days)]
    got = drift.numbered_files(spark.createDataFrame(rows, DDL)).orderBy("stream", "seq").collect()
    for stream in ("hot", "cold"):
        own = [r for r in got if r.stream == stream]
        assert [r.seq for r in own] == list(range(1, len(own) + 1)) and [r.file for r in own] == sorted(r.file for r in own)


def test_lifespans_are_islands(spark):
    files = [("s", f"f{i}", i, [{"year": y} if y is not None else {"x": 1}]) for i, y in enumerate(["a", "a", None, "a", 5], 1)]
    got = {(r.key, r.json_type, r.first_seq, r.last_seq) for r in drift.lifespans(raw(spark, *files), CHECKLIST_COLUMNS).collect()}
    assert got == {("year", "string", 1, 2), ("year", "string", 4, 4), ("year", "whole", 5, 5), ("x", "whole", 3, 3)}


def test_one_table(spark):
    payloads = [
        {"pmcid": "PMC1", "ehrUsed": 1, "links": "a; b", "llm": {"name": "m", "build": "q4"}, "availability": {"category": "in-house", "checked": True}, "pub_year": 2020, "other": 1},
        {"pmcid": "PMC2", "ehr_used": "no", "data_accession_links": [{"kind": "url", "id": "u"}], "model": ["m1", "m2"], "data_availability": 3},
        {"pmcid": "PMC3", "ehr_used": None, "accessions": ["x"], "model": "m"},
        "{broken",
    ]
    table = drift.unified(raw(spark, ("s", "f", 1, payloads)), CHECKLIST_TYPES, keep=["raw_id"]).orderBy("raw_id").collect()
    a, b, c, d = table
    assert (a.ehr_used, a.data_accession_links, a.model, a.data_availability, a.year, json.loads(a.extra)) == (True, ["a", "b"], "m-q4", "in-house", "2020", {"other": 1})
    assert (b.ehr_used, b.data_accession_links, b.model, b.data_availability, b.extra) == (False, ["u"], "m1; m2", "3", None)
    assert (c.ehr_used, c.data_accession_links, c.model, c.readable) == (None, ["x"], "m", True)
    assert (d.readable, d.pmcid, d.model, d.extra) == (False, None, None, None)


def test_names_that_clash_are_kept(spark):
    rows = raw(spark, ("s", "f", 1, [{"year": "1"}])).selectExpr("*", "'mine' as year", "'mine' as readable")
    row = drift.unified(rows, CHECKLIST_TYPES, keep=["year", "readable"]).first()
    assert (row.year_raw, row.readable_raw, row.year, row.readable) == ("mine", "mine", "1", True)


def test_lookup_joins_hot_and_other_keys_alike(spark):
    rows = spark.createDataFrame([(1 if i % 3 else i, i) for i in range(3000)] + [(None, -1)], "k int, v int")
    table = spark.createDataFrame([(i, f"t{i}", 2000 if i == 1 else 1) for i in range(0, 3000, 2)] + [(1, "t1", 2000)], "k int, t string, w int")
    got = lookup(rows, table, ["k"], ["t"], "w", hot_keys=3)
    want = rows.join(table.select("k", "t"), "k", "left").select("k", "v", "t")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_lists_written_as_texts(spark, tmp_path):
    import __spark_entry__ as entry

    cases = [
        ({"links": "phs926997.v4.p2 | phs974516.v3.p3"}, ["phs926997.v4.p2", "phs974516.v3.p3"]),
        ({"links": "GSE1234, https://x.org/a,b?c=1,2,GSE99,https://y.org"}, ["GSE1234", "https://x.org/a,b?c=1,2", "GSE99", "https://y.org"]),
        ({"links": "doi:10.99/d.8; E-MTAB-1, GSE5"}, ["doi:10.99/d.8", "E-MTAB-1", "GSE5"]),
        ({"links": ""}, []),
        ({"diseases": "childhood kidney injury, maternal anxiety"}, ["childhood kidney injury", "maternal anxiety"]),
        ({"diseases": "anaemia, iron deficiency; asthma"}, ["anaemia, iron deficiency", "asthma"]),
        ({"diseases": "epilepsy | mild wheeze|adhd"}, ["epilepsy", "mild wheeze", "adhd"]),
        ({"diseases": "cleft (lip, palate),wheeze"}, ["cleft (lip, palate)", "wheeze"]),
        ({"captured_features": "2,4-D in urine, age"}, ["2,4-D in urine", "age"]),
        ({"key_findings": "Risk rose, then fell. | No change"}, ["Risk rose, then fell.", "No change"]),
    ]
    raw(spark, ("s", "f", 1, [p for p, _ in cases])).write.parquet(str(tmp_path / "raw_checklists.parquet"))
    rows = entry.queries()["p4_table"](spark, str(tmp_path)).orderBy("raw_id").collect()
    column = {"links": "data_accession_links", "diseases": "pathologies_diseases"}
    assert [r[column.get(k, k)] for r, (p, _) in zip(rows, cases) for k in p] == [want for _, want in cases]


def test_two_keys_of_one_column(spark):
    payloads = [{"pub_year": "2002", "year": "2001"}, {"publication_year": "2003", "PubYear": "2002", "pub_year": None}, {"Year": "b", "YEAR": "a"}]
    rows = drift.unified(raw(spark, ("s", "f", 1, payloads)), CHECKLIST_TYPES, keep=["raw_id"]).orderBy("raw_id").collect()
    # the column's own name first, then its aliases in order, then by name; what does not count stays in extra
    assert [(r.year, json.loads(r.extra)) for r in rows] == [("2001", {"pub_year": "2002"}), ("2002", {"pub_year": None, "publication_year": "2003"}), ("a", {"Year": "b"})]
