"""Merging of listings against a fold spelled out row by row."""

import datetime as dt
import random

from pyspark.sql import functions as F

from callweave.operators import merge as M

SCHEMA = "key string, pos int, id string, journal string, journals array<string>, status string, deadline date, deadline_status string, topics array<string>, publisher string"
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


def ordered(*lists):
    return list(dict.fromkeys(x for held in lists for x in held or [] if x))


def brute(rows):
    """The fold, one row after another."""
    cur = None
    for inc in sorted(rows, key=lambda r: r["pos"]):
        if cur is None:
            cur = dict(inc)
            continue
        out = dict(inc)
        out["id"], out["journal"] = cur["id"] or inc["id"], cur["journal"] or inc["journal"]
        out["journals"] = ordered([out["journal"], cur["journal"], inc["journal"]], cur["journals"], inc["journals"])
        out["topics"] = ordered(cur["topics"], inc["topics"])
        if inc["status"] in (None, "unknown") and cur["status"] in ("open", "closed"):
            out["status"] = cur["status"]
        if cur["deadline"] and not inc["deadline"]:
            out["deadline"], out["deadline_status"] = cur["deadline"], cur["deadline_status"] or "listed"
        elif not inc["deadline"] and inc["deadline_status"] in (None, "not_checked") and cur["deadline_status"] == "not_listed":
            out["deadline_status"] = "not_listed"
        cur = out
    return cur


def listings(seed, keys=6, n=9):
    rng, rows = random.Random(seed), []
    for k in range(keys):
        for i in range(rng.randint(1, n)):
            rows.append({
                "key": f"k{k}", "pos": i, "id": f"{k}-{i}", "journal": rng.choice([None, "", "J0", "J1", "J2", "J3"]), "journals": rng.choice([None, [], ["J4", "J1"], ["J2", "J5"], ["J3"]]),
                "status": rng.choice(["open", "closed", "unknown", None, "odd"]), "deadline": rng.choice([None, None, dt.date(2027, 1, 1 + i)]), "deadline_status": rng.choice([None, "listed", "not_listed", "not_checked"]),
                "topics": rng.choice([None, ["a"], ["b", "a"], ["c"]]), "publisher": "P",
            })
    return rows


def test_folding_in_blocks_is_folding_in_order(spark, monkeypatch):
    rows = [r for seed in range(12) for r in ({**x, "key": f"{seed}{x['key']}"} for x in listings(seed))]
    df = spark.createDataFrame([tuple(r[c] for c in NAMES) for r in rows], SCHEMA)
    groups = {}
    for r in rows:
        groups.setdefault(r["key"], []).append(r)
    want = {k: brute(v) for k, v in groups.items()}
    for size in (2, 3, 1000):
        monkeypatch.setattr(M, "BLOCK", size)
        got = {r["key"]: r.asDict() for r in M.fold(df, ["key"], ["pos"]).collect()}
        assert got == want, size


def test_the_time_of_the_last_change_moves_with_the_content(spark):
    kind = "id string, title string, status string, content_hash string, last_changed string"
    plain = spark.createDataFrame([("a", "T", "open", None, "2026-01-01")], kind)
    own = plain.select(M.content_hash(dict(plain.dtypes)).alias("h")).first()["h"]
    stored = spark.createDataFrame([("a", "T", "open", own, "2026-01-01"), ("b", "T", "open", own, "2026-01-01"), ("c", "T", "open", own, "2026-01-01")], kind)
    new = spark.createDataFrame([("a", "T", "unknown", "x", "2026-02-02"), ("b", "Other", "open", "x", "2026-02-02"), ("d", "New", "open", "y", "2026-02-02")], kind)
    got = {r["id"]: (r["status"], r["last_changed"], r["content_hash"] == own) for r in M.upsert(stored, new).collect()}
    assert got == {"a": ("open", "2026-01-01", True), "b": ("open", "2026-02-02", False), "c": ("open", "2026-01-01", True), "d": ("open", "2026-02-02", False)}


def test_names_of_plos_journals(spark):
    kind = "id string, publisher string, journal string, journals array<string>"
    stored = spark.createDataFrame([("a", "PLOS", "PLOS One", ["x"]), ("b", "PLOS", "Other", None), ("c", "P", "PLOS One", ["x"])], kind)
    new = spark.createDataFrame([("a", "PLOS", "PLOS ONE, plos medicine", None), ("b", "PLOS", None, ["Unheard of"]), ("c", "P", "z", None)], kind)
    got = {r["id"]: (r["journal"], r["journals"]) for r in M.upsert(stored, new).collect()}
    assert got == {"a": ("PLOS Medicine", ["PLOS Medicine", "PLOS ONE"]), "b": ("Other", ["Other"]), "c": ("PLOS One", ["PLOS One", "z", "x"])}


def test_carry_forward_of_every_column(spark):
    new_kind = "id string, title string, url string, status string, deadline date, raw_deadline_status string, raw_deadline_checked_at timestamp_ntz, journal string, journals array<string>, source_keys array<string>, discovered_via string, publisher string, publisher_id string, domains array<string>, topics array<string>, publisher_keywords array<string>, summary string"
    old_kind = "id string, deadline date, deadline_status string, deadline_checked_at timestamp_ntz, status string, journal string, journals array<string>, source_keys array<string>, discovered_via string, publisher_id string, domains array<string>, topics array<string>, topics_method string, publisher_keywords array<string>, summary string, metadata_checked_at timestamp_ntz, first_seen date, content_hash string, last_changed timestamp_ntz"
    t0, day = dt.datetime(2026, 1, 1), dt.date(2027, 5, 1)
    url = "https://f.org/research-topics/77/x"
    incoming = spark.createDataFrame([
        ("a", "T", url, "unknown", None, None, None, "New", None, None, "s2", "P", None, ["hci"], ["n"], None, None),
        ("b", "T", url, "open", None, "not_listed", t0, "New", ["Also"], ["s1"], "s1", "P", "9", None, None, ["k"], "S"),
        ("c", "T", url, "open", day, None, None, "New", None, None, "s3", "P", None, None, ["n"], None, None),
    ], new_kind)
    stored = spark.createDataFrame([
        ("a", day, "listed", t0, "closed", "Old", ["Old", "Two"], ["s1"], "s1", "5", ["hri"], ["o"], "llm", None, "kept", t0, dt.date(2026, 1, 1), "h", t0),
        ("b", None, "not_checked", None, "open", "Old", ["Old"], None, "s0", None, ["hri"], ["o"], "none", ["was"], "kept", None, dt.date(2026, 1, 2), "h", t0),
    ], old_kind)
    now = F.lit("2026-10-15 12:00:00").cast("timestamp_ntz")
    out = {r["id"]: r for r in M.carry_forward(incoming, stored, now, F.lit("2026-10-15").cast("date")).collect()}
    a, b, c = out["a"], out["b"], out["c"]
    assert (a["deadline"], a["deadline_status"], a["deadline_checked_at"], a["status"], a["summary"], a["discovered_via"]) == (day, "listed", t0, "closed", "kept", "s1")
    assert (a["journal"], a["journals"], a["source_keys"], a["publisher_id"], a["domains"]) == ("Old", ["Old", "Two", "New"], ["s1", "s2"], "5", ["hci", "hri"])
    assert (a["topics"], a["topics_method"], a["metadata_checked_at"], a["first_seen"]) == (["o"], "llm", t0, dt.date(2026, 1, 1))
    assert (b["deadline_status"], b["deadline_checked_at"], b["journal"], b["journals"], b["publisher_id"]) == ("not_listed", t0, "New", ["New", "Also", "Old"], "9")
    assert (b["topics"], b["topics_method"], b["publisher_keywords"], b["summary"]) == (["o"], "publisher", ["k"], "S")
    assert (c["deadline_status"], c["topics"], c["topics_method"], c["publisher_id"], c["first_seen"]) == ("listed", ["n"], "none", "77", dt.date(2026, 10, 15))
    assert c["deadline_checked_at"] == c["last_changed"] == dt.datetime(2026, 10, 15, 12) and a["content_hash"].startswith("sha256:")
    again = stored.drop("content_hash", "last_changed").join(spark.createDataFrame([("a", a["content_hash"], t0)], "id string, content_hash string, last_changed timestamp_ntz"), "id")
    kept = M.carry_forward(incoming.where("id = 'a'"), again, now, F.lit("2026-10-15").cast("date")).first()
    assert kept["last_changed"] == t0
