import pytest

from callweave.llm.cut import _verdict, cut_rates, find_cut, last_runs, run_hashes, tokens

SCHEMA = "record_id long, source_key string, summary string, title string, source string, why string"


def corpus(n=60):
    rows = []
    for i in range(n):
        rows.append((i, "a", f"The group {i} asks how careful reading develops in classrooms. Authors are asked to explain their methods in detail.", f"Call {i}", None, "x"))
        rows.append((1000 + i, "b", f"Models of attention should be tested against data from many sources. Submission deadline: {i % 28 + 1} May 2027", f"Call {i}", None, None))
    return rows


def test_words_context_and_whole_ends(spark):
    rows = corpus() + [
        (5000, "a", "The group 7 asks how careful reading develops in classrooms. Authors are asked to expl", "Call 7", None, None),
        (5001, "a", "The group 8 asks how careful reading develops in classrooms. Authors are asked to", "Call 8", None, None),
        (5002, "a", "A headline about nothing much", "A headline about nothing much", None, None),
        (5003, "a", "Models of attention should be tested against data… Read more", "x", None, None),
        (5004, "a", "Models of attention should be tested against data from many sources.", "x", None, None),
        (5005, "a", "Reports on cats are rare (approx.", "x", None, None),
    ]
    found = {r["record_id"]: r["is_cut"] for r in find_cut(spark.createDataFrame(rows, SCHEMA), "record_id", "source_key", "summary", "title").collect()}
    assert [found[i] for i in range(5000, 5006)] == [True, True, False, True, False, True]
    assert not any(v for k, v in found.items() if k < 5000)


def test_field_limit_is_found(spark):
    import random

    rng = random.Random(1)
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    rows = []
    for i in range(200):
        text = " ".join(rng.choice(words) for _ in range(60)) + "."
        rows.append((i, "cut", text[:80].rstrip(), "t", None, None))
        rows.append((1000 + i, "free", text, "t", None, None))
    found = find_cut(spark.createDataFrame(rows, SCHEMA), "record_id", "source_key", "summary", "title")
    rates = {r["source"]: (r["n_texts"], r["n_cut"]) for r in cut_rates(found).collect()}
    assert rates["free"] == (200, 0)
    assert rates["cut"][1] >= 195


def test_nulls_blanks_repeats_long_texts_and_empty_tables(spark):
    long = "word " * 60_000 + "end."
    rows = [(1, None, None, None, "s", "w"), (2, "a", "", "t", "s", "w"), (3, "a", " ​ ", "t", "s", "w"), (4, "a", long, None, "s", "w"), (5, None, "It ends.", None, "s", "w"), (5, None, "It ends.", None, "s", "w")]
    out = find_cut(spark.createDataFrame(rows, SCHEMA), "record_id", "source_key", "summary", "title").collect()
    assert sorted(r["record_id"] for r in out) == [4, 5, 5]
    assert not any(r["is_cut"] for r in out)
    assert find_cut(spark.createDataFrame([], SCHEMA), "record_id", "source_key", "summary", "title").count() == 0


@pytest.mark.parametrize(("text", "verdict"), [
    ("A sentence.", "whole"), ("Was it?", "whole"), ("論文を募集します。", "whole"), ("It stops in the midd…", "cut"), ("It stops [...]", "cut"), ("broken �", "cut"),
    ("as in pupils, e.g.", "cut"), ("first, second,", "cut"), ("(see below)", "ask"), ("No more", "ask"), ("We do no more.", "whole"), ("long&nbs", "cut"),
])
def test_verdicts(text, verdict):
    assert _verdict(text) == verdict


def test_run_hashes_agree():
    import numpy as np

    from callweave.llm.cut import RUNS, _id

    words = tokens("one two three four five six seven eight")
    h = run_hashes(np.array([_id(w) for w in words], np.uint64))
    assert [int(h[n][-1].astype(np.int64)) for n in RUNS] == last_runs(words)
