import math
import random

import pytest

from callweave.operators import packed as K
from callweave.operators.packed import Codes, Scorer, finest, parses, unpack

SCHEMA = "record_id long, kws array<string>, pos string, keyword string, entry string"


@pytest.mark.parametrize(("entry", "values"), [
    ("a, b;c", ("a", "b", "c")), ('"sleep, REM"; x', ("sleep, REM", "x")), ("biosignals (EEG, EMG); y", ("biosignals (EEG, EMG)", "y")), ("10,000-step goals, z", ("10,000-step goals", "z")),
    ("24/7 monitoring / EEG/EMG fusion /", ("24/7 monitoring", "EEG/EMG fusion")), ('Keywords: "the ""uncanny"" effect" | b', ('the "uncanny" effect', "b")), ("KEYWORDS - a, b", ("a", "b")),
    ("['a', 'b, c']", ("a", "b, c")), ('["children\'s play", "x"]', ("children's play", "x")), ("one  two", ("one two",)), (" ; ;", ()), ("睡眠、学習", ("睡眠", "学習")), ("a : b : c", ("a", "b", "c")),
    ("children's play · Parkinson's gait", ("children's play", "Parkinson's gait")), ("“a, b”", ("a, b",)), ("a\n\nb\tc", ("a", "b", "c")),
])
def test_finest_parse(entry, values):
    assert finest(entry) == values
    assert Scorer(Codes()).cheapest(parses(entry)) == values


def test_rows_with_positions_and_edge_cases(spark):
    long = "; ".join(f"word {i % 50}" for i in range(20_000))
    rows = [(1, ["a; b", None, "", "c", "c"], "p", "k", "e"), (2, None, "p", "k", "e"), (3, [], "p", "k", "e"), (4, [" "], "p", "k", "e"), (5, [long], "p", "k", "e"), (1, ["a; b"], "p", "k", "e")]
    out = unpack(spark.createDataFrame(rows, SCHEMA), "record_id", "kws")
    got = sorted(map(tuple, out.where("record_id = 1").collect()))
    assert got == [(1, 0, "a"), (1, 0, "a"), (1, 1, "b"), (1, 1, "b"), (1, 2, "c"), (1, 3, "c")]
    assert out.where("record_id = 5").count() == 20_000
    assert out.where("record_id in (2, 3, 4)").count() == 0
    assert unpack(spark.createDataFrame([], SCHEMA), "record_id", "kws").count() == 0


def test_known_values_beat_a_finer_parse(spark):
    rows = [(i, ["alpha", "beta", "gamma; delta"], "", "", "") for i in range(50)] + [(99, ["alpha; beta"], "", "", "")]
    out = unpack(spark.createDataFrame(rows, SCHEMA), "record_id", "kws").where("record_id = 99").collect()
    assert [(r["pos"], r["keyword"]) for r in out] == [(0, "alpha"), (1, "beta")]


def test_the_finest_parse_loses_where_the_corpus_knows_coarser_values(spark):
    """Names with commas are values of their own here: the line of names is cut at semicolons only, other lines at commas."""
    names = ["Doe, Jane", "Roe, Kim", "Poe, Lee", "Moe, Max"]
    rows = [(i, [f'"{names[i % 4]}"', "touch", "sleep"], "", "", "") for i in range(80)]
    rows += [(100, ["Doe, Jane; Roe, Kim; Poe, Lee"], "", "", ""), (101, ["touch, sleep"], "", "", ""), (102, ["Moe, Max"], "", "", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    out = unpack(df, "record_id", "kws").where("record_id >= 100").orderBy("record_id", "pos").collect()
    assert [(r["record_id"], r["keyword"]) for r in out] == [(100, "Doe, Jane"), (100, "Roe, Kim"), (100, "Poe, Lee"), (101, "touch"), (101, "sleep"), (102, "Moe, Max")]
    assert finest("Doe, Jane; Roe, Kim") == ("Doe", "Jane", "Roe", "Kim")
    wins = {r["dialect"]: (r["entries"], r["coarser"]) for r in K.dialect_wins(df, "kws").collect()}
    assert wins == {";": (1, 1), ",": (5, 0), "whole": (1, 1)}  # the quoted names are open, too


def test_codes_follow_counts_exactly_and_unknown_values_are_spelled(spark):
    rows = [(i, [f"v{i % 7}", "w"], "", "", "") for i in range(70)] + [(99, ["once"], "", "", "")]
    codes, open_ = K.fitted_codes(spark.createDataFrame(rows, SCHEMA), "kws")
    assert open_.count() == 0
    scorer = Scorer(codes)
    assert scorer.value("w") == round(4 * math.log2(141 / 70)) / 4
    assert all(scorer.value(f"v{i}") == round(4 * math.log2(141 / 10)) / 4 for i in range(7))
    spelled = codes.escape + codes.stop + sum(codes.letters[c] for c in "once")
    assert scorer.value("once") == spelled


def test_worker_limits_change_nothing(spark, monkeypatch):
    """Few remembered entries and many small slices give the same rows."""
    rows = [(i, [f"a{i % 5}, b{i % 3}; c", '"x, y"', "x, y" if i % 9 == 0 else None], "", "", "") for i in range(90)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = sorted(map(tuple, unpack(df, "record_id", "kws").collect()))
    assert sorted(map(tuple, unpack(df.repartition(7), "record_id", "kws").collect())) == want


def test_the_bounded_search_finds_the_least_description():
    """Every parse scored in full gives the same choice, and an entry is open just where it has several parses."""
    rng = random.Random(4)
    words = ["sleep", "gaze cueing", "eye, hand", "VR", "C++", "it's", "10,000 steps", "x (a, b)", "'q'", '"r; s"', ""]
    codes = Codes(letters={c: 2 + (ord(c) % 7) for c in "abcdefghijklmnopqrstuvwxyz ,;\"'"}, rare_letter=9.0, dialects={",": 1.0, ";": 2.0, "whole": 1.5})
    for _ in range(400):
        entry = rng.choice([",", "; ", " | ", " / ", ", ", "\n"]).join(rng.choices(words, k=rng.randint(1, 5))) + rng.choice(["", ";", ", x | y"])
        options = parses(entry)
        scorer = Scorer(codes)
        full = min(options, key=lambda p: (round(codes.dialects.get(options[p], codes.rare_dialect) + sum(map(scorer.value, p)) + len(p), 3), -len(p), p)) if options else ()
        assert Scorer(codes).cheapest(options) == full
        assert (K.only_parse(entry) is None) == (len(options) > 1)
        if len(options) < 2:
            assert K.only_parse(entry)[0] == full
