from hypothesis import given, settings
from hypothesis import strategies as st

from callweave.llm.canon import Matcher, Tree, levenshtein, map_values, masks, plain, typing_errors

REFERENCE = [
    (1, "Gaze Science", "Halden Press", []),
    (2, "Gaze Science Letters", "Halden Press", ["GSL"]),
    (3, "Proceedings of the Tessera Society A", "Tessera Society", ["Proc Tessera A"]),
    (4, "Proceedings of the Tessera Society B", "Tessera Society", None),
    (5, "Language & Rhythm", None, []),
    (6, "視線科学論文誌", "Kaminari Gakkai", []),
]
REF_SCHEMA = "id long, name string, publisher string, aliases array<string>"
SCHEMA = "record_id long, journal string, journals array<string>, id long, value string"


def matcher():
    return Matcher([dict(zip(("id", "name", "publisher", "aliases"), r, strict=True)) for r in REFERENCE])


def test_readings():
    m = matcher()
    cases = {
        "gaze science": 1, "The Gaze Science": 1, "Gaze Sceince": 1, "Gaze Science (2026)": 1, "«Gaze Science»": 1, "Gaze Science – open access": 1, "Halden Press / Gaze Science": 1, "Gaze Sci. Lett.": 2, "gsl": 2,
        "Ｇａｚｅ Science​ Letters": 2, "Language and Rhythm": 5, "the Tessera Society B, Proceedings of": 4, "Proc. Tessera Soc. A": 3, "視線科論文誌": 6, "Proceedings of the Tessera Society C": -1,
        "n/a": -1, "Gaze Poetry": -1, "(multiple)": -1, "GSX": -1,
    }
    assert {k: m(k) for k in cases} == cases


def test_rows_positions_and_edge_cases(spark):
    rows = [(1, "Gaze Science", ["gaze science", None, "", " ", "Nothing Known At All"], 9, "v"), (2, None, None, 9, "v"), (3, "​", [], 9, "v"), (4, "x" * 20_000, ["GSL", "GSL"], 9, "v")]
    df, ref = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(REFERENCE, REF_SCHEMA)
    want = {(1, 1, 1), (1, 5, -1), (4, 0, -1), (4, 1, 2), (4, 2, 2)}
    assert {tuple(r) for r in map_values(df, "record_id", "journal", "journals", ref).collect()} == want
    assert {tuple(r) for r in map_values(df, "record_id", "journal", "journals", ref, broadcast_entries=2, shard_entries=2).collect()} == want
    assert map_values(spark.createDataFrame([], SCHEMA), "record_id", "journal", "journals", ref).count() == 0
    assert {r["id"] for r in map_values(df, "record_id", "journal", "journals", spark.createDataFrame([], REF_SCHEMA)).collect()} == {-1}


def slow(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i] + [0] * len(b)
        for j, y in enumerate(b, 1):
            row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.text("abcd", max_size=12), st.text("abcd", max_size=12))
def test_distances(a, b):
    d = slow(a, b)
    assert levenshtein(masks(a), len(a), b) == d
    assert typing_errors(a, b) <= d <= 2 * typing_errors(a, b)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=8), min_size=1, max_size=40, unique=True), st.text("abc", max_size=8), st.integers(0, 4))
def test_tree_returns_every_key_within(keys, asked, radius):
    tree = Tree([(k, i) for i, k in enumerate(keys)])
    assert sorted(k for _, k in tree.within(asked, radius)) == sorted(k for k in keys if slow(k, asked) <= radius)


def test_plain_form():
    assert plain("  The Études & du_Geste ") == "etudes and du geste"
    assert plain("The") == "the"
