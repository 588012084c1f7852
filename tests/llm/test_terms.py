from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from callweave.llm.terms import BurstTrie, items, local_tries, merge_tries, split_prefixes, term_frequencies
from callweave.session import settle

SCHEMA = "record_id long, words array<string>, term string, mark string"


def brute(rows):
    occurrences, records = Counter(), Counter()
    for _, words, *_ in rows:
        own = [w for w in words or [] if w]
        occurrences.update(own)
        records.update(set(own))
    return {t: (occurrences[t], records[t]) for t in occurrences}


def rows_of(n):
    return [(i, [f"term{i % 7}", "common", "common", f"only{i}", None, ""] if i % 5 else None, "x", "y") for i in range(n)]


def test_counts_and_marks_against_brute_force(spark):
    rows = rows_of(300) + [(1000, [], "x", "y"), (1001, ["twice"], "", ""), (1002, ["twice"], "", "")]
    out = term_frequencies(spark.createDataFrame(rows, SCHEMA), "words", items).collect()
    want = brute(rows)
    filled = sum(1 for r in rows if r[1])
    assert {r["term"]: (r["occurrences"], r["records"]) for r in out} == want
    marks = {r["term"]: r["mark"] for r in out}
    assert all(marks[t] == ("rare" if n <= 2 else "common" if n > 0.1 * filled else None) for t, (_, n) in want.items())


def test_routes_split_hot_prefixes(spark):
    rows = rows_of(400)
    subtrees = settle(local_tries(spark.createDataFrame(rows, SCHEMA), "words", items))
    assert len(split_prefixes(subtrees, 16, 20)) > 3
    few = {tuple(r) for r in merge_tries(subtrees, slots=16, least=20).collect()}
    assert few == {(t, o, n) for t, (o, n) in brute(rows).items()}


def test_empty_table_and_nulls(spark):
    assert term_frequencies(spark.createDataFrame([], SCHEMA), "words", items).count() == 0
    assert term_frequencies(spark.createDataFrame([(1, None, None, None), (2, [None, ""], None, None)], SCHEMA), "words", items).count() == 0


@settings(max_examples=50, deadline=None)
@given(st.lists(st.text(alphabet="abc", max_size=6), max_size=200), st.integers(1, 4))
def test_trie_holds_what_was_put(terms, limit):
    trie = BurstTrie(limit)
    for t in terms:
        trie.add(t, 1, 2)
    held = {p + s: c for p, box in trie.containers() for s, c in box.items()}
    assert held == {t: [n, 2 * n] for t, n in Counter(terms).items()}
    assert trie.size == len(held)


def test_long_common_prefixes_are_split_where_they_part(spark):
    from callweave.llm.terms import _route, split_prefixes

    stem = "x" * 300
    terms = [f"{stem}{a}{i:03}" for a in "ab" for i in range(120)] + ["y", "é" * 80 + "1", "é" * 80 + "2"]
    subtrees = spark.createDataFrame([("", terms, [1] * len(terms), [1] * len(terms))], "prefix string, suffixes array<string>, occurrences array<long>, records array<long>")
    split = split_prefixes(subtrees, 8, 30)
    routes = {}
    for t in terms:
        routes.setdefault(_route(t, split), []).append(t)
    assert {"", "x", stem, stem + "a", stem + "b0"} <= split and "y" not in split
    assert max(map(len, routes.values())) <= 30
