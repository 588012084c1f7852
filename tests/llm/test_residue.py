from callweave.llm.residue import Index, is_residue, mark_residue, spans, window_tokens, windows, without_residue

SCHEMA = "doc_id long, text string, is_residue string, token string"
CALL = "The Kakitedo collection invites case studies on rural teleoperation. Reports on shift workers are rare, and we hope to change that. Editors will check fit within 40 days."
CASES = {
    "404 Not Found\nMenu  Search  Sign in": True,
    "A title of a call\n\nPlease confirm that you are not a robot to see this call.": True,
    "Dear colleague, {{editor}} invites replications on low-cost touch.": True,
    "All papers will be listed under [insert journal name] once accepted. " + CALL: True,
    "Texte à venir. Texte à venir.": True,
    CALL + "\n\nText goes here.": True,
    "このページを表示するには、JavaScriptを有効にしてください。": True,
    CALL: False,
    CALL + "\n\nPlease enable JavaScript to use the comment form.": False,
    CALL + "\n\nThe old address may return 404 Not Found; use the link above.": False,
    "In the form letter, the slot {{name}} stands for the author and is filled in when the letter is sent. " + CALL: False,
    "Notation such as ${\\alpha}_i$ and $\\beta$ may be used in the abstract. " + CALL: False,
    "[PAD] [MASK] </s> " + CALL: False,
}


def test_cases(spark):
    filler = [(1000 + i, CALL.replace("40", str(i)), "x", "y") for i in range(60)]
    rows = [(i, t, "x", "y") for i, t in enumerate(CASES)] + filler
    got = {r["doc_id"]: r["is_residue"] for r in mark_residue(spark.createDataFrame(rows, SCHEMA), "doc_id", "text").collect()}
    assert [got[i] for i in range(len(CASES))] == list(CASES.values())
    kept = without_residue(spark.createDataFrame(rows, SCHEMA), "text")
    assert kept.columns == ["doc_id", "text", "is_residue", "token"]
    assert kept.count() == len(rows) - sum(CASES.values())


def test_nulls_blanks_long_texts_and_empty_tables(spark):
    rows = [(1, None, None, None), (2, "", None, None), (3, " \n\t", None, None), (4, (CALL + "\n") * 3000, None, None), (4, None, None, None)]
    assert [r["is_residue"] for r in mark_residue(spark.createDataFrame(rows, SCHEMA), "doc_id", "text").collect()] == [False] * 5
    assert without_residue(spark.createDataFrame(rows, SCHEMA), "text").count() == 5
    assert mark_residue(spark.createDataFrame([], SCHEMA), "doc_id", "text").count() == 0


def test_windows():
    assert [w.strip() for w in windows("One. Two?\n\nThree {{x}}")] == ["One.", "Two?", "Three {{x}}"]
    assert window_tokens("A 12 Testing 視線計") == ["a", "0", "testi", "視線", "線計"]
    assert spans("Dear {{ a.b }} and [x y]") == [("{{w}}", ["a", "b"], "a.b"), ("[w]", ["x", "y"], "x y")]
    assert is_residue(None, Index({}, 0)) is False
