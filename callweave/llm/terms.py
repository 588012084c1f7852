"""Frequency of every distinct term: burst tries, routed by adaptive prefixes and merged subtree by subtree.

Each worker puts its terms into a burst trie: containers of suffixes under a prefix, which burst by the next
character when they grow. Every suffix carries two counters, occurrences and records. A worker hands its containers
on when the trie is large or its input ends. Prefixes under which the workers together hold more than a share of all
suffixes are split, character by character; the split prefixes (at most ``slots`` a level, so their number has a
bound) tell every worker where each suffix goes. One shuffle brings matching subtrees together, which are merged.

A null or empty list counts for nothing; a term occurring twice in a record counts twice in ``occurrences`` and once
in ``records``; rows are records, repeats included.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callweave.session import settle

_SUBTREES = "prefix string, suffixes array<string>, occurrences array<long>, records array<long>"
_NAMES = ["prefix", "suffixes", "occurrences", "records"]


class BurstTrie:
    """Terms with two counters. A node is a dict by character; a leaf is a container (suffix to counters)."""

    def __init__(self, limit: int = 256):
        self.limit, self.size, self.root = limit, 0, Container()

    def add(self, term: str, occurrences: int, records: int) -> None:
        node, at, above, via = self.root, 0, None, ""
        while type(node) is dict:
            via = term[at : at + 1]
            above, node = node, node.get(via)
            if node is None:
                node = above[via] = Container()
            at += 1
        suffix = term[at:]
        if (own := node.get(suffix)) is not None:
            own[0] += occurrences
            own[1] += records
            return
        node[suffix] = [occurrences, records]
        self.size += 1
        if len(node) > self.limit and via != "" or above is None and len(node) > self.limit:
            burst: dict = {}
            for s, counters in node.items():
                burst.setdefault(s[:1], Container())[s[1:]] = counters
            if above is None:
                self.root = burst
            else:
                above[via] = burst

    def containers(self) -> Iterator[tuple[str, "Container"]]:
        """(prefix, container) in order of the prefix."""
        todo: list[tuple[str, dict]] = [("", self.root)]
        while todo:
            prefix, node = todo.pop()
            if type(node) is Container:
                yield prefix, node
            else:
                todo.extend((prefix + c, node[c]) for c in sorted(node, reverse=True))


class Container(dict):
    """The leaf of a burst trie."""


def items() -> Callable[[list | None], list[str]]:
    """The reader of lists whose items are terms: nulls and empty items are left out."""
    return lambda values: [v for v in values or () if v]


def _batch(rows: list[tuple[str | None, list[str], list[int], list[int]]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    kinds = (pa.string(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], _NAMES)


def _packed(trie: BurstTrie, rows: int = 512) -> Iterator[pa.RecordBatch]:
    out = []
    for prefix, held in trie.containers():
        order = sorted(held)
        out.append((prefix, order, [held[s][0] for s in order], [held[s][1] for s in order]))
        if len(out) == rows:
            yield _batch(out)
            out = []
    if out:
        yield _batch(out)


def local_tries(df: DataFrame, column: str, reader: Callable[[], Callable[[list], list[str]]], flush_at: int = 300_000) -> DataFrame:
    """The containers of every worker's tries, and a row with null prefix for the number of records that have a term.

    ``reader`` makes a worker's function from a value of ``column`` to the record's terms.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, trie, filled = reader(), BurstTrie(), 0
        for batch in batches:
            met: dict[str, list[int]] = {}
            for value in batch.column(0).to_pylist():
                terms = read(value)
                if not terms:
                    continue
                filled += 1
                for t in terms:
                    if (own := met.get(t)) is None:
                        met[t] = [1, 0]
                    else:
                        own[0] += 1
                for t in set(terms):
                    met[t][1] += 1
            for term, (occurrences, records) in met.items():
                trie.add(term, occurrences, records)
            if trie.size > flush_at:
                yield from _packed(trie)
                trie = BurstTrie()
        yield from _packed(trie)
        yield _batch([(None, [], [filled], [])])

    return df.select(column).where(F.col(column).isNotNull()).mapInArrow(run, _SUBTREES)


def _shared(a: str, b: str) -> int:
    """How many characters two terms begin with alike."""
    return next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def split_prefixes(subtrees: DataFrame, slots: int, least: int) -> set[str]:
    """Prefixes that hold more than max(least, all / slots) suffixes: at most ``slots`` at each depth where they part.

    A level is one job. All terms under a prefix begin as its first and last one do, so the search goes on where the first of
    the prefixes parts, however long they are.
    """
    held = subtrees.where("prefix is not null")
    total = held.agg(F.sum(F.size("suffixes"))).first()[0] or 0
    share = max(least, total // slots)
    if total <= share:
        return set()
    found, level, depth = {""}, [""], 1
    words = held.select(F.explode(F.expr("transform(suffixes, s -> concat(prefix, s))")).alias("term"))
    while True:
        words = words.where(F.substring("term", 1, depth - 1).isin(level)) if depth > 1 and len(level) < 64 else words
        heavy = (
            words.where(F.length("term") >= depth).groupBy(F.substring("term", 1, depth).alias("p"))
            .agg(F.count("*").alias("n"), F.min("term").alias("lo"), F.max("term").alias("hi")).where(F.col("n") > share).select("lo", "hi").collect()  # at most slots rows
        )
        if not heavy:
            return found
        parts = min(_shared(r["lo"], r["hi"]) for r in heavy)
        found.update(r["lo"][:k] for r in heavy for k in range(depth, parts + 1))
        level, depth = sorted({r["lo"][:parts] for r in heavy}), parts + 1


def _route(term: str, split: set[str]) -> str:
    """The shortest prefix of ``term`` that is not split; a term that is itself split has an end mark."""
    for depth in range(len(term) + 1):
        if term[:depth] not in split:
            return term[:depth]
    return term + "\0"


def merge_tries(subtrees: DataFrame, slots: int = 4096, least: int = 20_000) -> DataFrame:
    """(term, occurrences, records) of all workers together."""
    split = split_prefixes(subtrees, slots, least)
    shared = subtrees.sparkSession.sparkContext.broadcast(split)  # at most slots paths of the trie of prefixes

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = shared.value
        for batch in batches:
            out: dict[str, tuple[list, list, list]] = {}
            for row in batch.to_pylist():
                for s, o, r in zip(row["suffixes"], row["occurrences"], row["records"], strict=True):
                    term = row["prefix"] + s
                    own = out.setdefault(_route(term, cut), ([], [], []))
                    own[0].append(term)
                    own[1].append(o)
                    own[2].append(r)
            if out:
                yield _batch([(route, *own) for route, own in out.items()])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in batch.to_pylist())
        for _, same in groupby(rows, key=lambda row: row["prefix"]):
            trie = BurstTrie()
            for row in same:
                for term, o, r in zip(row["suffixes"], row["occurrences"], row["records"], strict=True):
                    trie.add(term, o, r)
            for prefix, held in trie.containers():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([prefix + s for s in held]), pa.array([c[0] for c in held.values()], pa.int64()), pa.array([c[1] for c in held.values()], pa.int64())],
                    ["term", "occurrences", "records"],
                )

    sent = subtrees.where("prefix is not null").mapInArrow(send, _SUBTREES)
    return sent.repartition("prefix").sortWithinPartitions("prefix").mapInArrow(merge, "term string, occurrences long, records long")


def term_frequencies(
    df: DataFrame, column: str, reader: Callable[[], Callable[[list], list[str]]], rare: int = 2, common: float = 0.1,
) -> DataFrame:
    """Every distinct term: ``term``, ``occurrences``, ``records``, ``mark``.

    ``mark`` is 'rare' where at most ``rare`` records have the term, else 'common' where more than the share
    ``common`` of the records with a term have it, else null.
    """
    subtrees = settle(local_tries(df, column, reader))
    filled = subtrees.where("prefix is null").agg(F.sum(F.col("occurrences")[0])).first()[0] or 0
    mark = F.when(F.col("records") <= rare, "rare").when(F.col("records") > common * filled, "common")
    return merge_tries(subtrees).withColumn("mark", mark)
