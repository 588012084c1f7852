import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from callweave.operators.snapshots import Lookup, diff_snapshots, difference, digests

SCHEMA = "source string, no int, url string, status string, deadline string, loaded_at int, key string, grp string"


def brute(rows):
    held = {}
    for source, no, url, status, deadline, at, *_ in sorted(rows, key=lambda r: (r[5], r[3] or "", r[4] or "")):
        if url is not None and no is not None:
            held.setdefault((source, no), {})[url] = (status, deadline)
    out = set()
    for s in {k[0] for k in held}:
        numbers = sorted(n for x, n in held if x == s)
        for a, b in zip(numbers, numbers[1:]):
            old, new = held[s, a], held[s, b]
            for u in old.keys() | new.keys():
                if u not in old or u not in new or old[u] != new[u]:
                    out.add((s, b, u, "added" if u not in old else "removed" if u not in new else "changed"))
    return out


def changes(spark, rows, **sizes):
    df = spark.createDataFrame(rows, SCHEMA)
    out = diff_snapshots(df, "source", "no", F.col("url"), [F.col("status"), F.col("deadline")], "loaded_at", **sizes)
    return {tuple(r) for r in out.collect()}


def listing(n, seed, change=0.1):
    rng, rows, at = random.Random(seed), [], 0
    for source in ("a", "b", None):
        state = {f"u{i}": ("open", None) for i in range(n)}
        for no in (1, 2, 4):
            for u in list(state):
                if rng.random() < change:
                    kind = rng.randrange(3)
                    if kind == 0:
                        del state[u]
                    elif kind == 1:
                        state[u] = (rng.choice(["open", "closed", None]), rng.choice([None, "2027-01-01"]))
                    else:
                        state[f"{u}x{no}"] = ("open", None)
            for u, (s, d) in state.items():
                at += 1
                rows.append((source, no, u, s, d, at, "x", "y"))
    return rows


@pytest.mark.parametrize("sizes", [{}, {"rows_per_bucket": 64, "cells": 12, "rounds": 1}, {"rows_per_bucket": 64, "cells": 24, "rounds": 2}])
def test_against_brute_force(spark, sizes):
    rows = listing(150, 7)
    rows += [("a", 2, "u1", "closed", "2030-01-01", 10_000, "x", "y")] * 3 + [("a", 2, None, "open", None, 1, "x", "y")]
    assert changes(spark, rows, **sizes) == brute(rows)


def test_everything_changed_takes_the_exact_way(spark):
    rows = [("s", 1, f"u{i}", "open", None, i, "", "") for i in range(300)] + [("s", 2, f"w{i}", "open", None, i, "", "") for i in range(300)]
    assert changes(spark, rows, rows_per_bucket=300, cells=12, rounds=2) == brute(rows)


def test_edges(spark):
    assert changes(spark, []) == set()
    assert changes(spark, [("s", 3, "u", "open", None, 1, "", "")]) == set()
    assert changes(spark, [("s", 1, "u", None, None, 1, "", ""), ("s", 2, "u", "open", None, 1, "", "")]) == {("s", 2, "u", "changed")}
    assert changes(spark, [("s", 1, "u" * 50_000, None, None, 1, "", ""), ("s", 2, "v", None, None, None, "", "")]) == {("s", 2, "u" * 50_000, "removed"), ("s", 2, "v", "added")}


def elements(n, seed, tables=3):
    rng = np.random.default_rng(seed)
    return rng.integers(0, tables, n), rng.choice([1, -1], n), rng.integers(0, 2**63, n).astype(np.uint64), rng.integers(0, 2**63, n).astype(np.uint64)


def as_set(t, s, k, v):
    return set(zip(t.tolist(), s.tolist(), k.tolist(), v.tolist(), strict=True))


def test_peeling_is_a_round_trip():
    own = elements(60, 3)
    lookup = Lookup(3, 40)
    lookup.add(*own)
    assert as_set(*lookup.peel()) == as_set(*own) and lookup.empty().all()


def test_a_full_table_is_stuck_and_then_enlarged_or_compared():
    t, s, k, v = elements(400, 5, 2)
    small = Lookup(2, 4)
    small.add(t, s, k, v)
    small.peel()
    assert not small.empty().any()
    want = set(zip(t.tolist(), k.tolist(), strict=True))
    for cells, rounds, compared in ((12, 1, 2), (300, 3, 0)):
        ft, fk, exact = difference(t, s, k, v, 2, cells, rounds)
        assert set(zip(ft.tolist(), fk.tolist(), strict=True)) == want and exact == compared


def test_the_digest_catches_what_empty_cells_hide(monkeypatch):
    """An element lost from all its cells leaves a table that peels to nothing: only the digest of the rows tells."""
    t, s, k, v = elements(30, 9, 1)
    lookup = Lookup(1, 40)
    lookup.add(t, s, k, v)
    lookup.add(t[:1], -s[:1], k[:1], v[:1])
    found = lookup.peel()
    assert lookup.empty().all() and len(found[0]) == 29
    assert (digests(*found, 1) != digests(t, s, k, v, 1)).all()

    kept = Lookup.add
    monkeypatch.setattr(Lookup, "add", lambda self, t, s, k, v: kept(self, t[1:], s[1:], k[1:], v[1:]) if len(t) and (s == 1).all() else kept(self, t, s, k, v))
    ft, fk, exact = difference(t, s, k, v, 1, 384, 2)
    assert exact == 1 and set(fk.tolist()) == set(k.tolist())  # every table failed its digest, the exact way gave all


def test_a_key_repeated_very_often_and_a_hot_source(spark):
    rows = [("hot", 1, "u", ["open", "closed"][i % 2], None, i, "", "") for i in range(3000)] + [("hot", 2, f"u{i % 900}", "open", None, i, "", "") for i in range(1800)]
    assert changes(spark, rows, rows_per_bucket=64) == brute(rows)
