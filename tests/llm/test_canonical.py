import random

import pytest

from lectern.llm import canonical

TERMS = [
    (1, "f", "air pollution", ["ambient air pollutants"]),
    (2, "f", "lead exposure", ["plumbism", "Pb burden"]),
    (3, "f", "traffic noise", None),
    (4, "f", "pollen", ["", None]),
    (5, "g", "case-control study", ["RCT"]),
    (6, None, "x", None),
    (7, "f", None, ["y"]),
    (8, "g", "randomised controlled trial", ["RCT"]),
]


@pytest.fixture(scope="module")
def terms(spark):
    return spark.createDataFrame(TERMS, "term_id long, field string, term string, alt_terms array<string>")


def mapped(spark, terms, *values, field="f"):
    rows = spark.createDataFrame([(i, field, v) for i, v in enumerate(values)], "id int, field string, value string")
    return [(r.term_id, r.match_by) for r in canonical.map_values(rows, terms, synonyms=None).orderBy("id").collect()]


def test_names_aliases_and_spellings(spark, terms):
    assert mapped(spark, terms, "AIR  Pollution", "ambient-air-pollutants", "plumbism") == [(1, "name"), (1, "name"), (2, "name")]
    assert [t for t, _ in mapped(spark, terms, "pollution, air", "air polution", "Lead exposrue (mainly)", "trafic niose", "lead exp.", "polluting the air")] == [1, 1, 2, 3, 2, 1]


def test_mentions_inside_longer_values(spark, terms):
    assert mapped(spark, terms, "mainly air pollution in a mining district", "air pollution from factories and cars") == [(1, "mention"), (1, "mention")]
    # the longest mention wins, and one that is a small part of what is said does not
    assert mapped(spark, terms, "pollen and lead exposure")[0] == (2, "mention")
    assert mapped(spark, terms, "pollen-coloured wallpaper", "lead author affiliation", "air travel frequency") == [(0, "none")] * 3


def test_part_of_a_name_that_one_term_has(spark):
    names = spark.createDataFrame([(1, "f", "famine and undernutrition", None), (2, "f", "traffic noise", None), (3, "f", "railway noise", None)], "term_id long, field string, term string, alt_terms array<string>")
    assert [t for t, _ in mapped(spark, names, "undernutrition", "famine", "noise", "traffic", "undernutrition novel", "on and of")] == [1, 0, 0, 2, 0, 0]


def test_words_beside_many_terms_are_filler(spark, terms):
    said = ["pollen, third trimester", "lead exposure, third trimester", "traffic noise: third trimester", "air pollution - third trimester"]
    assert mapped(spark, terms, said[0]) == [(0, "none")]
    assert [t for t, _ in mapped(spark, terms, *said)] == [4, 2, 3, 1]
    # beside one term, however often, a word may change the meaning
    assert [t for t, _ in mapped(spark, terms, *["pollen-coloured wallpaper"] * 9, *said)] == [0] * 9 + [4, 2, 3, 1]
    rows = spark.createDataFrame([(f, v) for f, v in [("f", x) for x in said] + [("f", None), (None, "pollen wall")]], "field string, value string")
    got = {r.word: (r.n, r.n_terms) for r in canonical.filler_words(rows, canonical.reference_names(terms)).collect()}
    assert got == {"third": (4, 4), "trimester": (4, 4)}


def test_names_of_the_caller(spark, terms):
    rows = spark.createDataFrame([("f", "very smoggy"), ("f", "road traffic")], "field string, value string")
    got = canonical.map_values(rows, terms, synonyms={"f": {"air pollution": ["smoggy"], "no term": ["road"]}})
    assert [r.term_id for r in got.orderBy("value").collect()][1] == 1


def test_values_that_say_nothing(spark, terms):
    assert {t for t, _ in mapped(spark, terms, None, "", "  ", " ", "n/a", "??", "2010", "of the in", "x" * 100_000, "a " * 5000)} == {0}


def test_fields_are_apart(spark, terms):
    assert mapped(spark, terms, "pollen", "RCT", field="g") == [(0, "none"), (5, "name")]
    assert mapped(spark, terms, "pollen", field="unknown") == [(0, "none")]


def test_repeats_and_clashing_columns(spark, terms):
    rows = spark.createDataFrame([(1, "f", "pollen", 9), (1, "f", "pollen", 9)], "id int, field string, value string, term_id int")
    got = canonical.map_values(rows, terms)
    assert got.columns == ["id", "field", "value", "term_id", "match_by", "match_score"] and [r.term_id for r in got.collect()] == [4, 4]


def test_empty_tables(spark, terms):
    none = spark.createDataFrame([], "id int, field string, value string")
    assert canonical.map_values(none, terms).count() == 0
    rows = spark.createDataFrame([(1, "f", "pollen")], none.schema)
    assert canonical.map_values(rows, terms.limit(0)).first().term_id == 0


def test_a_list_that_is_too_long_is_refused(spark, terms):
    with pytest.raises(ValueError, match="more than"):
        canonical.reference_names(terms, max_names=2)
    with pytest.raises(ValueError, match="more than"):
        canonical.without_exact(spark.createDataFrame([], "field string, value string"), terms, max_names=2)


def test_typed_values_and_report(spark, terms):
    rows = spark.createDataFrame([(1, "pollen", None), (2, "odd", " "), (3, " odd", "odd")], "rec_id long, f string, g string")
    values = canonical.typed_values(rows, ["f", "g"])
    assert sorted((r.rec_id, r.field, r.value) for r in values.collect()) == [(1, "f", "pollen"), (2, "f", "odd"), (3, "f", " odd"), (3, "g", "odd")]
    left = canonical.without_exact(values, terms)
    assert left.count() == 3
    report = canonical.unmatched_report(canonical.map_values(left, terms, synonyms=None))
    assert sorted((r.field, r.value, r.n_rows) for r in report.collect()) == [("f", " odd", 1), ("f", "odd", 1), ("g", "odd", 1)]


def test_edits_against_the_definition():
    def plain(a, b):
        d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
        return d[len(a), len(b)]

    r = random.Random(5)
    for _ in range(500):
        a, b = ("".join(r.choice("abc") for _ in range(r.randrange(7))) for _ in range(2))
        for most in (0, 1, 2, 5):
            assert canonical.edits(a, b, most) == min(plain(a, b), most + 1)


def test_words_within_two_edits_share_a_shortened_form():
    r = random.Random(8)
    for _ in range(3000):
        a = "".join(r.choice("ab") for _ in range(r.randrange(6, 12)))
        b = "".join(r.choice("ab") for _ in range(r.randrange(6, 12)))
        if canonical.edits(a, b, 2) <= 2:
            assert canonical.shortened(a, 2) & canonical.shortened(b, 2)


def test_single_typos_of_every_term_are_found(spark, data):
    """Held-out accuracy: one random edit in every reference term of the test table."""
    rows = spark.read.parquet(f"{data}/canonical_terms.parquet")
    names = canonical.reference_names(rows)
    r, right, all_ = random.Random(3), 0, 0
    for row in rows.collect():
        index = canonical.FieldIndex(names[row.field], 0.68, 0.5)
        for _ in range(5):
            at = r.randrange(len(row.term))
            typed = row.term[:at] + r.choice(["", "x", row.term[at] * 2]) + row.term[at + 1 :]
            right += index.resolve(typed)[0] == row.term_id
            all_ += 1
    assert right / all_ > 0.97
