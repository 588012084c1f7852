import itertools
import unicodedata

from callweave.llm.looks import INVISIBLE, LOOK_ALIKES, one_form, same_look_pairs, tables

SCHEMA = "record_id long, title string, summary string, form string, raw string"


def forms(spark, texts):
    rows = [(i, t, None, "x", "y") for i, t in enumerate(texts)]
    out = one_form(spark.createDataFrame(rows, SCHEMA), "record_id", ["title", "summary"]).collect()
    return [r["title"] for r in sorted(out, key=lambda r: r["record_id"])]


def test_forms(spark):
    assert forms(spark, ["a​b", "ﾊﾞｰﾁｬﾙ", "ＡＢ１２", "Ⅲ ﬁne", "café", "сор", "a b", "A‐B", " x ", "", None, "­ "]) == ["ab", "バーチャル", "AB12", "III fine", "café", "cop", "a b", "A-B", "x", None, None, None]


def test_what_is_seen_stays_different(spark):
    out = forms(spark, ["Abc", "abc", "ábc", "abc1", "abc.", "a–b", "a-b", "a  b", "a b"])
    assert len(set(out)) == len(out)


def test_pairs_against_brute_force(spark):
    base = ["Haptic reading", "Haptic  reading", "haptic reading", "バーチャル"]
    rows = []
    for i, t in enumerate(base):
        for j, change in enumerate([lambda s: s, lambda s: s, lambda s: s[:3] + "​" + s[3:], lambda s: unicodedata.normalize("NFD", s), lambda s: s.replace("a", "а"), lambda s: s.replace(" ", " ")]):
            rows.append((10 * i + j, change(t), t if j % 2 else None, "x", "y"))
    df = spark.createDataFrame(rows, SCHEMA)
    form = {i: f for i, f in zip([r[0] for r in rows], forms(spark, [r[1] for r in rows]))}
    want = {("title", a[0], b[0]) for a, b in itertools.combinations(rows, 2) if form[a[0]] == form[b[0]] and a[1] != b[1]}
    got = {tuple(r) for r in same_look_pairs(df, "record_id", ["title", "summary"]).collect()}
    assert got == want


def test_repeated_rows_nulls_long_texts_and_empty_tables(spark):
    long = "long text " * 50_000
    rows = [(1, long, None, "", ""), (2, long + "​", None, "", ""), (3, None, None, "", ""), (4, "x", None, "", ""), (5, "x", None, "", "")]
    assert {tuple(r) for r in same_look_pairs(spark.createDataFrame(rows, SCHEMA), "record_id", ["title", "summary"]).collect()} == {("title", 1, 2)}
    assert same_look_pairs(spark.createDataFrame([], SCHEMA), "record_id", ["title", "summary"]).count() == 0


def test_tables_are_one_to_one():
    single, longer = tables()
    for own in single.values():
        assert all(len(k) == 1 and len(v) == 1 for k, v in own.items())
    assert all(len(v) > 1 for v in longer.values())
    assert all(ord(k) > 127 and ord(v) < 256 for k, v in LOOK_ALIKES.items())
    assert " " not in INVISIBLE
