import re

from callweave.operators import topics as T

CALLS = "id string, title string, summary string, status string, topics array<string>"
TERMS = ["遠隔操作", "視線計測", "高齢者", "脳", "脳波eeg", "haptics", "ψ", "…", "мозг", "𝛼波"]
TEXTS = {
    "a": ("遠隔操作の特集", None), "b": ("Calls", "on 視線計測, and haptics"), "c": ("高齢者と脳波eegの研究", ""), "d": ("脳波eegs, haptics2", "ψ"), "e": ("遠隔\n操作", "мозг и…"), "f": ("Мозг", "𝛼波 in sleep"), "g": ("遠隔", "操作 視線 計測"), "h": ("nothing", None), "i": (None, "の脳"),
}


def test_a_large_catalog_gives_what_a_small_one_gives(spark):
    rows = [(str(i), f"{a} of {b}", f"On {b} and {c}.") for i, (a, b, c) in enumerate([("Sleep", "robots", "遠隔操作"), ("gaze cueing", "touch", "VR sleep"), (None, "sleeping", "vr"), ("x", "C++ toolkits", "gaze")])]
    calls = spark.createDataFrame(rows, "id string, title string, summary string")
    terms = spark.createDataFrame([(k, k, n, [k]) for n, k in enumerate(["sleep", "gaze", "gaze cueing", "遠隔操作", "c++ toolkits", "vr", "touch"])], "key string, label string, n int, needles array<string>")
    told = lambda most: {r["id"]: r["matches"] for r in T.catalog_matches(calls, terms, most_terms=most).collect()}
    assert told(0) == told(5_000) and told(0)["1"] == ["touch", "vr", "gaze cueing", "gaze", "sleep"]


def test_terms_without_ascii_are_matched(spark):
    terms = spark.createDataFrame([(t, t.upper(), 1, [t]) for t in TERMS], "key string, label string, n int, needles array<string>")
    calls = spark.createDataFrame([(i, *x, "open", None) for i, x in TEXTS.items()], CALLS)
    want = {}
    for i, x in TEXTS.items():  # every pair of text and term
        text = " ".join(p for p in x if p).lower()
        if found := [t.upper() for t in sorted(TERMS) if re.search(rf"(?<![a-z0-9]){re.escape(t)}(?![a-z0-9])", text)]:
            want[i] = found
    matches = T.catalog_matches(calls, terms)
    assert {r["id"]: r["matches"] for r in matches.collect()} == want
    assert {t for found in want.values() for t in found} == {t.upper() for t in TERMS}


def test_catalog_and_overlay_keep_terms_without_ascii(spark):
    rows = [("a", "x", None, "open", ["遠隔操作"]), ("b", "y", None, "open", ["遠隔操作"]), ("c", "遠隔操作の特集", None, "open", ["haptics"])]
    calls = spark.createDataFrame(rows, CALLS)
    got = {r["id"]: r["topics"] for r in T.overlay(calls, T.catalog_matches(calls, T.catalog(calls))).collect()}
    assert "遠隔操作" in got["c"] and "遠隔操作" in got["a"]
