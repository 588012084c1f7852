from callweave.llm import cut
from callweave.llm.cut import _id, _verdict, beginnings, find_cut, last_tokens, tokens

SCHEMA = "record_id long, source_key string, summary string, title string"


def test_bracket_opened_far_from_the_end():
    long = "the many groups that we know of, " * 30
    assert _verdict(f"We ask for reports. Some (among {long}are rare.") == "cut"
    assert _verdict(f"We ask for reports. Some (among {long}are) are rare.") == "whole"
    assert _verdict(f"Some (among {long}are rare. They are known.") == "whole"


def test_cut_inside_a_long_word_whose_rest_is_a_word(spark):
    word = "Donaudampfschifffahrtsgesellschaftskapitaen"
    rest = word[:34]
    rows = [(i, "a", f"Reports of group {i} by the old {word} are asked for here.", "Call") for i in range(60)]
    rows += [(100, "a", f"A {rest} is known.", "Call"), (101, "b", f"Reports of group 7 by the old {rest}", "Call")]
    found = {r["record_id"]: r["is_cut"] for r in find_cut(spark.createDataFrame(rows, SCHEMA), "record_id", "source_key", "summary", "title").collect()}
    assert [i for i, cut in found.items() if cut] == [101]


def test_beginnings_of_long_words():
    for word in ("ab", "Ünïcode" * 40, "脳" * 70):
        assert beginnings(word, 1) == [_id(word[:n]) for n in range(1, len(word))] and beginnings(word, 2) == beginnings(word, 1)[1:]


def test_last_tokens_are_those_of_the_whole_text():
    for text in ("a b c", "x" * 3000 + " b", " ".join("w" * 400 for _ in range(12)), "https://a.b/" + "c" * 900 + " " + "d " * 30, "一" * 700, "one, two (three) 1234567890 four"):
        assert last_tokens(text) == tokens(text)[-8:]


def test_marks_far_from_the_end_and_long_blanks():
    assert _verdict("It stops here ..." + " " * 200 + "read more") == "cut"
    assert _verdict("It stops here [more]") == "cut" and _verdict("There is no more") == "ask"
    assert tokens("1234567 12345678") == ["0000000", "00000000"]


def test_a_filter_that_lets_all_pass_changes_nothing(spark, monkeypatch):
    rows = [(i, "a", f"The group {i} asks how careful reading develops in classrooms. Authors are asked to explain their methods in detail.", f"Call {i}") for i in range(60)]
    rows += [(100 + i, "a", f"The group {i} asks how careful reading develops in class", "x") for i in range(5)] + [(200, "b", "Authors are asked to", "y"), (201, "b", "Authors are asked to expl", "y")]
    df = spark.createDataFrame(rows, SCHEMA)
    told = lambda: sorted((r["record_id"], r["why"], tuple(r["evidence"])) for r in find_cut(df, "record_id", "source_key", "summary", "title").collect())
    want = told()
    assert {r[0] for r in want if r[1]} >= {100, 101, 102, 103, 104, 200, 201}
    monkeypatch.setattr(cut, "LEAST_BITS", 6)
    monkeypatch.setattr(cut, "MOST_BITS", 6)
    assert told() == want


def test_each_kind_of_evidence_is_told(spark):
    rows = [(i, "a", f"Reports of group {i} on careful reading are asked for here.", "Call") for i in range(60)]
    rows += [(100, "b", "Reports of group 7 on careful rea", "Call"), (101, "b", "Reports of group 7 on careful rea…", "Call"), (102, "b", "Reports of group 7 on", "Call"), (103, "b", "Reports of unheardofword", "Call")]
    got = {r["record_id"]: r["evidence"] for r in find_cut(spark.createDataFrame(rows, SCHEMA), "record_id", "source_key", "summary", "title").collect()}
    assert "trie" in got[100] and got[101] == ["trie", "mark"] and got[102] == ["context"]
    assert got[103] == []  # an unknown word that begins no known one is no evidence
