"""Mixing sources to target weights by entropy balancing.

The copies of a document are drawn at a rate; the rates of a source's documents are the ones nearest to one
(in relative entropy) that give the source its target number of tokens and none more than ``max_repeats``. They are
exponentially tilted by document size: rate = min(max_repeats, exp(dual * tokens / mean tokens)). The convex dual has one
unknown a source and its Newton steps need two sums a source; documents of one size have one rate, so they are counted
by source and size once and an iteration is one aggregation over that table;
steps that leave the known bracket are bisected. Rates are then rounded to copies so that the counts of every block
of documents, and of all blocks before it, are right to within one copy (systematic rounding along a cumulative sum
in blocks of bounded size, by document size, so that tokens are nearly right too).

Targets: weights are made to add up to one over the sources that have a positive weight and tokens; a null or
negative weight and a source without tokens get no share and are reported so; exact repeats of a target row count once;
of rows that contradict each other the largest weight holds (then the largest ``max_repeats``); a null
``max_repeats`` is 1. The total is ``total`` tokens, by default the tokens of all documents of targeted sources. A source that
cannot reach its share even with every document at ``max_repeats`` gets all of that, and what it lacks is shared out
among the others by weight. Documents of sources without a target are not in the mixture, nor are empty ones.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from callweave.session import settle

#: Sources that the table of targets may name: the dual is solved for all of them at once on the driver.
MOST_SOURCES = 100_000


def _targets(targets: DataFrame) -> list[dict]:
    """One row a source: source, weight, max_repeats."""
    rows = (
        targets.where(F.col("source").isNotNull()).groupBy("source")
        .agg(F.max(F.struct("weight", "max_repeats")).alias("t"))
        .select("source", "t.weight", F.greatest(F.coalesce("t.max_repeats", F.lit(1)), F.lit(0)).alias("max_repeats"))
        .limit(MOST_SOURCES + 1).collect()
    )
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources have a target")
    return sorted((r.asDict() for r in rows), key=lambda r: r["source"])


def fill(weights: dict[str, float], most: dict[str, float], total: float) -> dict[str, float]:
    """Tokens for each source: proportional to the weights, none above ``most``; what is lacking goes to the others."""
    out: dict[str, float] = {}
    open_ = dict(weights)
    left = total
    while open_:
        whole = sum(open_.values())
        full = [s for s, w in open_.items() if left * w / whole >= most[s]]
        if not full:
            return out | {s: left * w / whole for s, w in open_.items()}
        for s in full:
            out[s] = most[s]
            left = max(0.0, left - most[s])
            del open_[s]
    return out


def solve_duals(sizes: DataFrame, spark: SparkSession, wanted: dict[str, float], cap: dict[str, int], mean: dict[str, float], tolerance: float = 1e-6, rounds: int = 40) -> dict[str, float]:
    """The dual of each source: Newton steps for the token constraint, safeguarded by bisection.

    ``sizes`` has a row for each source and document size (source, n_tokens, n), so a step reads a table as small as the
    number of different sizes. A source whose target is all it can give has the dual +inf. A source that does not
    come within ``tolerance`` of its target raises an error: no unfinished mixture is returned.
    """
    duals = {s: 0.0 for s in wanted}
    low, high = {s: -60.0 for s in wanted}, {s: 60.0 for s in wanted}
    open_ = set(wanted)
    for _ in range(rounds):
        if not open_:
            break
        table = spark.createDataFrame([(s, duals[s], float(cap[s]), mean[s]) for s in sorted(open_)], "source string, dual double, cap double, mean double")
        x = F.col("n_tokens") / F.col("mean")
        rate = F.least(F.col("cap"), F.exp(F.col("dual") * x))
        slope = F.when(F.exp(F.col("dual") * x) < F.col("cap"), rate * x * F.col("n_tokens")).otherwise(0.0)
        sums = sizes.join(table, "source").groupBy("source").agg(F.sum(F.col("n") * rate * F.col("n_tokens")).alias("got"), F.sum(F.col("n") * slope).alias("slope")).collect()  # a row a targeted source
        for r in sums:
            s, gap = r["source"], r["got"] - wanted[r["source"]]
            if abs(gap) <= tolerance * max(1.0, wanted[s]):
                open_.discard(s)
                continue
            if gap > 0:
                high[s] = min(high[s], duals[s])
            else:
                low[s] = max(low[s], duals[s])
            step = duals[s] - gap / r["slope"] if r["slope"] > 0 else math.inf
            duals[s] = step if low[s] < step < high[s] else (low[s] + high[s]) / 2
    if open_:
        raise ArithmeticError(f"no dual within {tolerance} of the target after {rounds} rounds: {', '.join(sorted(open_)[:10])}")
    return duals


def mixture(documents: DataFrame, targets: DataFrame, id_column: str = "doc_id", total: float | None = None, block_rows: int = 4096) -> tuple[DataFrame, DataFrame]:
    """(copies, shares) for ``documents`` with the columns ``id_column``, source, n_tokens.

    copies: id, source, n_tokens, rate, copies (documents with no copy are left out).
    shares: source, target_share, wanted_tokens, actual_tokens, actual_share, documents, copies, full (the source gives all it may).
    """
    spark = documents.sparkSession
    asked = _targets(targets)
    sized = documents.where((F.col("n_tokens") > 0) & F.col("source").isNotNull())
    names = [r["source"] for r in asked]
    plain = spark.createDataFrame([(s,) for s in names], "source string")
    sized = sized.join(plain, "source", "left_semi").select(id_column, "source", "n_tokens")
    sizes = settle(sized.groupBy("source", "n_tokens").agg(F.count("*").alias("n")))
    have = {r["source"]: r for r in sizes.groupBy("source").agg(F.sum(F.col("n") * F.col("n_tokens")).alias("tokens"), F.sum("n").alias("n")).collect()}  # a row a targeted source
    cap = {r["source"]: r["max_repeats"] for r in asked}
    weights = {r["source"]: r["weight"] for r in asked if r["weight"] is not None and r["weight"] > 0 and not math.isinf(r["weight"]) and r["source"] in have and cap[r["source"]] > 0}
    whole = sum(weights.values())
    most = {s: float(cap[s] * have[s]["tokens"]) for s in weights}
    wanted = fill(weights, most, float(total if total is not None else sum(have[s]["tokens"] for s in weights)))
    mean = {s: have[s]["tokens"] / have[s]["n"] for s in weights}
    duals = solve_duals(sizes, spark, {s: t for s, t in wanted.items() if t < most[s]}, cap, mean)
    table = spark.createDataFrame(
        [(s, duals.get(s, math.inf), float(cap[s]), mean[s], -(-have[s]["n"] // block_rows)) for s in sorted(weights)],
        "source string, dual double, cap double, mean double, blocks long",
    )
    tilted = F.when(F.col("dual") == math.inf, F.col("cap")).otherwise(F.least(F.col("cap"), F.exp(F.col("dual") * F.col("n_tokens") / F.col("mean"))))
    rated = settle(
        sized.join(table, "source").select(id_column, "source", "n_tokens", tilted.alias("rate"), F.pmod(F.xxhash64(id_column), F.col("blocks")).alias("block"))
    )
    # Systematic rounding: a cumulative sum over blocks (a row each), then inside each block of about block_rows documents.
    blocks = rated.groupBy("source", "block").agg(F.sum("rate").alias("sum"))
    before = F.coalesce(F.sum("sum").over(Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    line = Window.partitionBy("source", "block").orderBy("n_tokens", id_column).rowsBetween(Window.unboundedPreceding, 0)
    upto = F.col("before") + F.sum("rate").over(line)
    copies = (
        rated.join(blocks.select("source", "block", before.alias("before")), ["source", "block"])
        .withColumn("upto", upto)
        .select(id_column, "source", "n_tokens", "rate", (F.floor(F.col("upto") + 0.5 + 1e-9) - F.floor(F.col("upto") - F.col("rate") + 0.5 + 1e-9)).cast("int").alias("copies"))
        .where("copies > 0")
    )
    goal = spark.createDataFrame(
        [(r["source"], (weights[r["source"]] / whole if r["source"] in weights else None), wanted.get(r["source"], 0.0), r["source"] in weights and r["source"] not in duals) for r in asked],
        "source string, target_share double, wanted_tokens double, full boolean",
    )
    got = copies.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("actual_tokens"), F.count("*").alias("documents"), F.sum("copies").alias("copies"))
    shares = goal.join(got, "source", "left").fillna(0, ["actual_tokens", "documents", "copies"])
    return copies, shares.withColumn("actual_share", F.col("actual_tokens") / F.nullif(F.sum("actual_tokens").over(Window.partitionBy(F.lit(0))), F.lit(0)))  # a row a targeted source
