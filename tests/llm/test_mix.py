import math

from callweave.llm.mix import fill, mixture

DOCS = "doc_id long, source string, n_tokens long, rate double, block long"
TARGETS = "source string, weight double, max_repeats int, dual double"


def documents(spark):
    rows = [(i, "big", 100 + i % 37, 0.0, 0) for i in range(2000)] + [(10_000 + i, "small", 50 + i % 11, 0.0, 0) for i in range(100)] + [(20_000 + i, "tiny", 40, 0.0, 0) for i in range(5)]
    rows += [(30_000, None, 10, 0.0, 0), (30_001, "untargeted", 10, 0.0, 0), (30_002, "big", 0, 0.0, 0)]
    return spark.createDataFrame(rows, DOCS)


def test_shares_follow_weights(spark):
    targets = spark.createDataFrame([("big", 3.0, 4, 0.0), ("small", 1.0, 50, 0.0), ("small", 1.0, 50, 0.0), ("none", 2.0, 1, 0.0), ("nothing", None, 1, 0.0)], TARGETS)
    copies, shares = mixture(documents(spark), targets, total=200_000)
    got = {r["source"]: r for r in shares.collect()}
    assert math.isclose(got["big"]["actual_share"], 0.75, abs_tol=0.005)
    assert math.isclose(got["small"]["actual_share"], 0.25, abs_tol=0.005)
    assert math.isclose(got["big"]["target_share"] + got["small"]["target_share"], 1.0)
    assert got["none"]["target_share"] is None and got["nothing"]["actual_tokens"] == 0
    rows = copies.collect()
    assert {r["source"] for r in rows} == {"big", "small"}
    assert all(0 < r["copies"] <= {"big": 4, "small": 50}[r["source"]] for r in rows)
    assert sum(r["copies"] * r["n_tokens"] for r in rows if r["source"] == "big") == got["big"]["actual_tokens"]


def test_repeats_are_capped_and_the_rest_shared_out(spark):
    targets = spark.createDataFrame([("big", 1.0, 4, 0.0), ("tiny", 1.0, 3, 0.0)], TARGETS)
    copies, shares = mixture(documents(spark), targets, total=100_000)
    got = {r["source"]: r for r in shares.collect()}
    assert got["tiny"]["actual_tokens"] == 5 * 40 * 3 and got["tiny"]["full"]
    assert math.isclose(got["big"]["actual_tokens"], 100_000 - 600, rel_tol=0.005)
    assert all(r["copies"] == 3 for r in copies.where("source = 'tiny'").collect())


def test_empty_tables(spark):
    none = spark.createDataFrame([], TARGETS)
    copies, shares = mixture(documents(spark), none)
    assert copies.count() == 0 and shares.count() == 0
    copies, shares = mixture(spark.createDataFrame([], DOCS), spark.createDataFrame([("big", 1.0, 2, 0.0)], TARGETS))
    assert copies.count() == 0
    assert shares.collect()[0]["actual_share"] is None


def test_fill():
    assert fill({"a": 1, "b": 1}, {"a": 10.0, "b": 100.0}, 100) == {"a": 10.0, "b": 90.0}
    assert fill({"a": 1, "b": 1}, {"a": 10.0, "b": 20.0}, 100) == {"a": 10.0, "b": 20.0}
    assert fill({}, {}, 5) == {}
