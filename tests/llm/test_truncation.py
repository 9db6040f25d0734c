import random

from lectern.llm import truncation

DDL = "rec_id long, feed string, body string"
THINGS = ["asthma", "wheeze", "eczema", "obesity", "preterm birth", "otitis media"]
PLACES = ["the northern valley", "four river towns", "a mining district"]


def whole_texts(n, seed=1):
    r = random.Random(seed)
    made = []
    for _ in range(n):
        a, b = r.sample(THINGS, 2)
        made.append(
            r.choice(
                [
                    f"The study examined whether {a} is associated with {b} among children in {r.choice(PLACES)}.",
                    f"Effects of {a} were largest in the second trimester, while later levels added little.",
                    f"Costs of {a} linked to {b} were put at {r.randrange(2, 90)} percent of the budget of {r.choice(PLACES)}.",
                ]
            )
        )
    return [" ".join(made[i : i + 2]) for i in range(0, n, 2)]


def found(spark, rows, fields=("body",)):
    df = spark.createDataFrame(rows, DDL)
    return {(r.id, r.cause) for r in truncation.truncated(df, list(fields)).collect()}


def limits_of(spark, rows):
    texts = truncation.texts_of(spark.createDataFrame(rows, DDL), ["body"], "rec_id", "feed")
    return {(x.source, x.measure, x.limit) for x in truncation.limits(truncation.open_texts(texts, ["body"])).collect()}


def test_cut_texts_are_found_and_whole_ones_are_not(spark):
    texts = whole_texts(1200)
    rows = [(i, "good", t) for i, t in enumerate(texts)]
    cuts = {
        9001: texts[0][:-20],
        9002: texts[1][:40],
        9003: texts[2][: texts[2].index(" ", 50)],
        9004: texts[3][:60] + "…",
        9005: texts[4][:60] + "&am",
        9006: texts[5][:61] + "�",
        9007: texts[6][:62] + " [cut]",
    }
    unmarked = {9100 + i: t[:-1] for i, t in enumerate(whole_texts(60, seed=2))}
    rows += [(i, "bad", t) for i, t in cuts.items()] + [(i, "typed", t) for i, t in unmarked.items()]
    got = {i for i, _ in found(spark, rows)}
    assert got & set(range(9000)) == set()
    assert set(cuts) <= got
    assert len(got & set(unmarked)) <= 1


def test_hidden_limits_by_encoding(spark):
    r = random.Random(4)
    rows = []
    for i in range(400):
        body = "".join(r.choice('ab é"\n&') for _ in range(r.randrange(10, 200)))
        rows += [(i, "free", body), (i, "chars", body[:100]), (i, "bytes", body.encode()[:90].decode(errors="ignore"))]
        escaped = 0
        for at, c in enumerate(body):
            escaped += 2 if c in '"\n' else 1
            if escaped > 80:
                body = body[:at]
                break
        rows.append((i, "json", body))
    # one row a limit, under the measure that names it
    assert limits_of(spark, rows) == {("chars", "chars", 100), ("bytes", "utf8", 90), ("json", "json", 80)}


def test_lengths_are_exact():
    import json

    for text in ("plain", 'a"b\\c\nd\te', "é&<>", "😀x", ""):
        assert dict(zip(truncation.MEASURES, truncation.lengths(text), strict=True)) == {"chars": len(text), "utf8": len(text.encode()), "utf16": len(text.encode("utf-16-le")) // 2, "entities": len(text) + 4 * text.count("&") + 3 * text.count("<") + 3 * text.count(">") + 5 * text.count('"'), "json": len(json.dumps(text, ensure_ascii=False)) - 2, "crlf": len(text) + text.count("\n")}


def test_texts_at_a_limit(spark):
    texts = [t for t in whole_texts(2000) if len(t) > 120]
    rows = [(i, "cut", t[:120]) for i, t in enumerate(texts)] + [(5000 + i, "cut", t) for i, t in enumerate(whole_texts(20)) if len(t) < 120]
    got = found(spark, rows)
    assert {i for i, t in enumerate(texts) if t[:120][-1] not in ".!?"} <= {i for i, _ in got}
    assert not {i for i, _ in got if i >= 5000}


def test_phrases_are_whole(spark):
    rows = [(i, "f", t) for i, t in enumerate(whole_texts(200))] + [(1000 + i, "f", "Not stated") for i in range(30)] + [(2000, "f", "Not sta")]
    got = {i for i, _ in found(spark, rows)}
    assert 2000 in got and not got & set(range(1000, 1030))


def test_numbers_that_end_a_text(spark):
    rows = [(i, "f", f"Each rise went with {i % 3}.{10 + i % 80} times the odds of asthma.") for i in range(300)] + [(999, "f", "Each rise went with 1."), (998, "f", "A rise. It is given in file 2.")] + [(3000 + i, "f", f"It is given in file {i % 9}.") for i in range(40)]
    got = {i for i, _ in found(spark, rows)}
    assert 999 in got and 998 not in got


def test_nulls_blanks_repeats_long_and_empty(spark):
    long = "The cat sat on the mat. " * 20_000
    rows = [(1, None, None), (2, None, "  "), (None, None, "Cut off…"), (4, "f", "Cut off…"), (4, "f", "Cut off…"), (5, "f", long)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], f"{DDL}, source string, n int")
    got = sorted((str(r.id), r.source, r.cause) for r in truncation.truncated(df, ["body"]).collect())
    assert got == [("4", "f", "mark"), ("4", "f", "mark"), ("None", "", "mark")]
    none = spark.createDataFrame([], DDL)
    assert truncation.truncated(none, ["body"]).count() == 0 and truncation.shares(none, truncation.truncated(none, ["body"]), ["body"]).count() == 0


def test_repeated_endings_are_reported_as_often(spark):
    rows = [(i, "f", t) for i, t in enumerate(whole_texts(300))] + [(777, "g", "The study examined whether asthma is asso")] * 2
    got = [r for r in truncation.truncated(spark.createDataFrame(rows, DDL), ["body"]).collect() if r.id == 777]
    assert len(got) == 2


def test_shares(spark):
    rows = [(1, "a", "Fine text."), (2, "a", "Cut te…"), (3, None, "Fine text."), (4, "a", None)]
    df = spark.createDataFrame(rows, DDL)
    got = {r.source: (r.n, r.n_truncated, r.share) for r in truncation.shares(df, truncation.truncated(df, ["body"]), ["body"]).collect()}
    assert got == {"a": (2, 1, 0.5), "": (1, 0, 0.0)}


def test_copies_of_a_damaged_record_are_judged_by_their_ending(spark):
    texts = whole_texts(300)
    rows = [(i, f"f{i % 3}", t, f"PMC{i}") for i, t in enumerate(texts)] + [(1000 + i, f"f{i % 3}", "Not stated", f"PMC{1000 + i}") for i in range(30)]
    # one record in a third of all rows, and one template cut by one feed in many records
    rows += [(2000 + i, "f1", texts[0][:40], "PMC0") for i in range(90)] + [(3000 + i, "f2", "Effects of asthma were largest in the sec", f"PMC{3000 + i}") for i in range(10)]
    df = spark.createDataFrame(rows, f"{DDL}, paper string")
    got = [r.id for r in truncation.truncated(df, ["body"], record=truncation.F.col("paper")).collect()]
    assert sorted(got) == [*range(2000, 2090), *range(3000, 3010)]


def test_limits_below_the_greatest_length(spark):
    texts = [t for t in whole_texts(2000) if len(t) > 160]
    half = len(texts) // 2
    # two stores behind one feed, and one text longer than both; templates and phrases of one length are no limit
    rows = [(i, "f", t[:120] if i < half else t[:150]) for i, t in enumerate(texts)] + [(7000, "f", texts[0])]
    rows += [(8000 + i, "g", f"Raw files are archived (GSE{90000000 + i})") for i in range(60)] + [(8500 + i, "g", "Not stated") for i in range(60)] + [(9000 + i, "g", t) for i, t in enumerate(whole_texts(400, seed=3))]
    assert limits_of(spark, rows) == {("f", "chars", 120), ("f", "chars", 150)}
    lost = {i for i, t in enumerate(texts) if (t[:120] if i < half else t[:150])[-1] not in ".!?"}
    assert lost <= {i for i, cause in found(spark, rows) if cause == "limit"}


def test_a_longer_row_a_feed_hides_no_limit(spark):
    texts = [t for t in whole_texts(1200) if len(t) > 150]
    rows = [(i, f"f{i % 3}", t[: 120 + 10 * (i % 3)]) for i, t in enumerate(texts)] + [(5000 + i, f"f{i}", t + " " + t) for i, t in enumerate(texts[:3])]
    assert limits_of(spark, rows) == {("f0", "chars", 120), ("f1", "chars", 130), ("f2", "chars", 140)}


def test_cuts_before_a_wide_character(spark):
    """A text one to three bytes short of its limit, as the next character did not fit, is at the limit."""
    texts = [t.replace("asthma", "âsthmä") for t in whole_texts(2500) if len(t) > 150]
    cut = [t.encode()[:121].decode(errors="ignore") for t in texts]
    got = found(spark, [(i, "f", t) for i, t in enumerate(cut)])
    short = [i for i, t in enumerate(cut) if len(t.encode()) == 120 and t[-1] not in ".!?"]
    assert len(short) > 5 and {(i, "limit") for i in short} <= got


def test_repeated_tables_give_the_same_limits_and_phrases(spark):
    texts = whole_texts(700)
    rows = [(i, f"f{i % 3}", t[:110] if i % 3 == 1 else t, f"PMC{i}") for i, t in enumerate(texts)]
    rows += [(1000 + i, f"f{i % 3}", "Not stated", f"PMC{1000 + i}") for i in range(30)] + [(2000 + i, "f0", t[:50], f"PMC{2000 + i}") for i, t in enumerate(whole_texts(40, seed=5))]
    many = [(i + 10_000 * n, *rest) for n in range(10) for i, *rest in rows]
    one, ten = ({(r.id % 10_000, r.cause) for r in truncation.truncated(spark.createDataFrame(x, f"{DDL}, paper string"), ["body"], record=truncation.F.col("paper")).collect()} for x in (rows, many))
    at_limit = lambda got: {i for i, cause in got if cause == "limit"}
    assert at_limit(one) == at_limit(ten) and len(at_limit(one)) > 50
    assert not {i for i, _ in one | ten} & set(range(1000, 1030))


def test_ends_of_other_scripts_and_long_closers(spark):
    texts = ["研究对象为儿童。", "क्या यह सच है।", "هل هذا صحيح؟", 'He said "so.' + '"' * 60, "So it is.」"]
    assert not found(spark, [(i, "f", t) for i, t in enumerate(texts)])


def test_the_filter_loses_nothing(spark):
    import numpy as np

    r = random.Random(9)
    held = [r.randrange(-(1 << 63), 1 << 63) for _ in range(3000)]
    other = np.array([r.randrange(-(1 << 63), 1 << 63) for _ in range(20_000)], np.int64)
    df = spark.createDataFrame([(x,) for x in held], "context long")
    for most in (1 << 20, 64):
        made = truncation.context_filter(df, most_words=most)
        assert len(made) <= most and truncation.passes(made, np.array(held, np.int64)).all()
    assert truncation.passes(truncation.context_filter(df), other).mean() < 0.05


def test_contexts_are_counted_as_by_hand(spark):
    """The counts that pass the filter against a plain count of the last word."""
    texts = whole_texts(100)
    df = spark.createDataFrame([(i, "f", t) for i, t in enumerate(texts)], DDL)
    rows = truncation.texts_of(df, ["body"], "rec_id", "feed")
    everything = truncation.np.full(64, (1 << 64) - 1, truncation.np.uint64)
    counted = {r.context: (r.ends, r.goes_on) for r in truncation.context_counts(rows, ["body"], everything).collect()}
    probe = spark.createDataFrame([(0, "f", "among children in four river")], DDL)
    last = truncation.open_texts(truncation.texts_of(probe, ["body"], "rec_id", "feed"), ["body"]).first()["last"]
    words = [w for t in texts for w in t.split()]
    assert counted[last] == (0, words.count("river")) and words.count("river") > 0
