"""What changed between full snapshots: invertible Bloom lookup tables per hash bucket, subtracted and peeled.

A group (a source) delivers full listings now and then; consecutive listings of a group are compared by key. Rows are
first reduced to one for each (group, listing, key, value), combined before the shuffle, and then brought together by
hash bucket of (group, key), so that a group with a third of all rows is spread over all buckets and every bucket holds
about as many rows. For each bucket and pair of listings there are two tables, one of the later and one of the earlier
listing; a row is an element (key hash, value hash) in three cells of its table. The earlier table is subtracted from the
later one: what both hold alike cancels. The difference is peeled: a cell with a single element gives it up, which frees
others. All tables of an Arrow batch are filled, subtracted and peeled at once, as arrays.

A table is believed if it comes out empty and the elements it gave up add up to its digest, a sum of other hashes that
is made of the rows and not of the cells. Otherwise it is built again four times as large; after ``rounds`` rounds its
listings are compared row by row. Recovered key hashes lead back to their rows, which classify the keys by their true
values.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callweave.session import settle

PARTS = 3
_CHECK, _DIGEST = 99, 7


def latest_candidates(df: DataFrame, group: str, snapshot: str, key: Column, values: list[Column], loaded_at: str) -> DataFrame:
    """(grp, snap, key, v0.., at): each value of a key in a listing once, with the time it was last loaded.

    Rows without key or snapshot are left out; a null group is a group of its own.
    """
    named = [v.alias(f"v{i}") for i, v in enumerate(values)]
    rows = df.select(F.coalesce(F.col(group).cast("string"), F.lit("\0")).alias("grp"), F.col(snapshot).cast("int").alias("snap"), key.alias("key"), *named, F.col(loaded_at).alias("at"))
    return rows.where("key is not null and snap is not null").groupBy("grp", "snap", "key", *[f"v{i}" for i in range(len(values))]).agg(F.max("at").alias("at"))


def _hash(hk: np.ndarray, hv: np.ndarray, seed: int) -> np.ndarray:
    """A hash of pairs of 64-bit numbers."""
    h = (hk ^ np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xBF58476D1CE4E5B9)
    h = ((h ^ (h >> np.uint64(32))) + hv) * np.uint64(0x94D049BB133111EB)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def digests(tables: np.ndarray, signs: np.ndarray, hk: np.ndarray, hv: np.ndarray, count: int) -> np.ndarray:
    """For each table the sum of its elements' digest hashes, those of the earlier listing taken away."""
    out = np.zeros(count, np.uint64)
    h = _hash(hk, hv, _DIGEST)
    np.add.at(out, tables, np.where(signs > 0, h, np.uint64(0) - h))
    return out


class Lookup:
    """``count`` invertible Bloom lookup tables of ``PARTS * width`` cells each."""

    def __init__(self, count: int, width: int):
        self.count, self.width = count, width
        cells = count * PARTS * width
        self.n, self.hk, self.hv, self.check = np.zeros(cells, np.int64), np.zeros(cells, np.uint64), np.zeros(cells, np.uint64), np.zeros(cells, np.uint64)

    def places(self, tables: np.ndarray, hk: np.ndarray, hv: np.ndarray) -> np.ndarray:
        base = tables * (PARTS * self.width)
        return np.concatenate([base + j * self.width + (_hash(hk, hv, j) % np.uint64(self.width)).astype(np.int64) for j in range(PARTS)])

    def add(self, tables: np.ndarray, signs: np.ndarray, hk: np.ndarray, hv: np.ndarray) -> None:
        """Elements added (sign 1) or taken away (sign -1)."""
        if not len(tables):
            return
        at = self.places(tables, hk, hv)
        order = np.argsort(at, kind="stable")
        at = at[order]
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        cells, rows = at[first], order % len(tables)
        self.n[cells] += np.add.reduceat(signs[rows], first)
        for held, own in ((self.hk, hk), (self.hv, hv), (self.check, _hash(hk, hv, _CHECK))):
            held[cells] ^= np.bitwise_xor.reduceat(own[rows], first)

    def subtract(self, other: Lookup) -> None:
        self.n -= other.n
        for own, his in ((self.hk, other.hk), (self.hv, other.hv), (self.check, other.check)):
            own ^= his

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(tables, signs, key hashes, value hashes) of the elements that come out."""
        out: list[tuple[np.ndarray, ...]] = []
        for _ in range(PARTS * self.width + 1):  # each round frees a cell of each table that is not stuck
            pure = np.flatnonzero(np.abs(self.n) == 1)
            pure = pure[_hash(self.hk[pure], self.hv[pure], _CHECK) == self.check[pure]]
            if not len(pure):
                break
            tables, signs, hk, hv = pure // (PARTS * self.width), self.n[pure], self.hk[pure], self.hv[pure]
            order = np.lexsort((hv, hk, tables))  # an element may be alone in several cells
            tables, signs, hk, hv = tables[order], signs[order], hk[order], hv[order]
            new = np.r_[True, (tables[1:] != tables[:-1]) | (hk[1:] != hk[:-1]) | (hv[1:] != hv[:-1])]
            found = tables[new], signs[new], hk[new], hv[new]
            out.append(found)
            self.add(found[0], -found[1], found[2], found[3])
        kinds = (np.int64, np.int64, np.uint64, np.uint64)
        return tuple(np.concatenate([o[i] for o in out]) if out else np.zeros(0, kind) for i, kind in enumerate(kinds))

    def empty(self) -> np.ndarray:
        """Which tables hold nothing."""
        some = (self.n != 0) | (self.hk != 0) | (self.hv != 0) | (self.check != 0)
        return ~some.reshape(self.count, -1).any(axis=1)


def difference(tables: np.ndarray, signs: np.ndarray, hk: np.ndarray, hv: np.ndarray, count: int, cells: int, rounds: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(tables, key hashes) of the elements that only one side has, and how many tables were compared row by row."""
    wanted = digests(tables, signs, hk, hv, count)
    found_t, found_k, open_ = [], [], np.arange(count)
    for r in range(rounds):
        place = np.full(count, -1)
        place[open_] = np.arange(len(open_))
        mine = place[tables] >= 0
        t, s, k, v = place[tables[mine]], signs[mine], hk[mine], hv[mine]
        later, earlier = Lookup(len(open_), max(1, cells * 4**r // PARTS)), Lookup(len(open_), max(1, cells * 4**r // PARTS))
        for table, side in ((later, s > 0), (earlier, s < 0)):
            table.add(t[side], np.ones(int(side.sum()), np.int64), k[side], v[side])
        later.subtract(earlier)
        pt, ps, pk, pv = later.peel()
        good = later.empty() & (digests(pt, ps, pk, pv, len(open_)) == wanted[open_])
        kept = good[pt]
        found_t.append(open_[pt[kept]])
        found_k.append(pk[kept])
        open_ = open_[~good]
        if not len(open_):
            break
    if len(open_):  # the exact way for what no table could hold
        mine = np.isin(tables, open_)
        t, k, v = tables[mine], hk[mine], hv[mine]
        order = np.lexsort((v, k, t))
        t, k, v = t[order], k[order], v[order]
        same = (t[1:] == t[:-1]) & (k[1:] == k[:-1]) & (v[1:] == v[:-1])
        alone = ~(np.r_[same, False] | np.r_[False, same])
        found_t.append(t[alone])
        found_k.append(k[alone])
    return np.concatenate(found_t), np.concatenate(found_k), len(open_)


def _changes(block: pa.Table, values: list[str], cells: int, rounds: int) -> pa.RecordBatch:
    """The changes of whole buckets, their rows sorted by bucket, key hash, key, group, listing, time and value."""
    number = lambda name: block.column(name).to_numpy()
    hk, snap = number("hk"), number("snap")
    same = np.zeros(len(hk), bool)
    if len(hk) > 1:
        equal = lambda name: pc.equal(block.column(name)[1:], block.column(name)[:-1]).to_numpy()
        same[:-1] = (hk[1:] == hk[:-1]) & (snap[1:] == snap[:-1]) & equal("key") & equal("grp")
    last = np.flatnonzero(~same)  # of several rows for a key the one loaded last
    after = number("after")
    plus, minus = last[number("has_before")[last]], last[after[last] >= 0]
    rows = np.r_[plus, minus]
    pairs = np.r_[snap[plus], after[minus]].astype(np.int64)
    signs = np.r_[np.ones(len(plus), np.int64), -np.ones(len(minus), np.int64)]
    _, tables = np.unique(np.stack([number("bucket")[rows].astype(np.int64), pairs]), axis=1, return_inverse=True)
    tables = tables.reshape(-1)
    ek, ev = hk[rows].view(np.uint64), number("hv")[rows].view(np.uint64)
    found_t, found_k, _ = difference(tables, signs, ek, ev, int(tables.max()) + 1 if len(tables) else 0, cells, rounds) if len(rows) else (np.zeros(0, np.int64), np.zeros(0, np.uint64), 0)
    hit = np.flatnonzero(np.isin(_hash(ek, tables.astype(np.uint64), 1), _hash(found_k, found_t.astype(np.uint64), 1)))
    held = block.select(["grp", "key", *values]).take(pa.array(rows[hit])).to_pydict()
    sides: dict[tuple, list] = {}
    for pair, sign, grp, key, *own in zip(pairs[hit].tolist(), signs[hit].tolist(), held["grp"], held["key"], *[held[v] for v in values], strict=True):
        sides.setdefault((grp, pair, key), [None, None])[sign < 0] = own
    kinds = [(g, p, k, "removed" if new is None else "added" if old is None else "changed") for (g, p, k), (new, old) in sides.items() if new != old]
    out = list(zip(*kinds, strict=True)) or [[], [], [], []]
    return pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.string()), pa.array(out[3], pa.string())], ["grp", "snapshot_no", "key", "change_kind"])


def diff_snapshots(
    df: DataFrame, group: str, snapshot: str, key: Column, values: list[Column], loaded_at: str,
    rows_per_bucket: int = 512, cells: int = 384, rounds: int = 3,
) -> DataFrame:
    """The changes between consecutive listings of each group: grp, snapshot_no (the later one), key, change_kind.

    Null is a value of its own. Of several rows for one key in one listing the one with the latest ``loaded_at``
    holds; ties by value. A group's first listing gives no change; a date without rows is no listing. An empty table gives
    no row. ``rows_per_bucket`` is about what a bucket has of one listing of all groups.
    """
    rows = settle(latest_candidates(df, group, snapshot, key, values, loaded_at))
    line = Window.partitionBy("grp").orderBy("snap")  # one row for each listing of a group
    listings = rows.groupBy("grp", "snap").agg(F.count("*").alias("n"))
    total, several = listings.agg(F.sum("n"), F.count_distinct("snap")).first()
    buckets = max(1, -(-(total or 0) // (rows_per_bucket * max(1, several))))
    listings = listings.select("grp", "snap", F.lag("snap").over(line).isNotNull().alias("has_before"), F.coalesce(F.lead("snap").over(line), F.lit(-1)).alias("after"))
    own = [f"v{i}" for i in range(len(values))]
    hv = F.xxhash64(*[F.coalesce(F.concat(F.lit("v"), F.col(v).cast("string")), F.lit("n")) for v in own])  # null is a value of its own
    placed = rows.join(listings, ["grp", "snap"]).withColumns({"hk": F.xxhash64("grp", "key"), "hv": hv})
    placed = placed.withColumn("bucket", F.pmod("hk", F.lit(buckets)).cast("long"))
    together = placed.repartition("bucket").sortWithinPartitions("bucket", "hk", "key", "grp", "snap", "at", *own).drop("at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        for batch in batches:
            bucket = batch.column("bucket").to_numpy()
            if not len(bucket):
                continue
            cut = int(np.searchsorted(bucket, bucket[-1]))  # the last bucket may go on
            if cut or (rest and rest[-1].column("bucket")[-1].as_py() != bucket[-1]):
                yield _changes(pa.Table.from_batches([*rest, batch.slice(0, cut)], batch.schema), own, cells, rounds)
                rest = []
            rest.append(batch.slice(cut))
        if rest:
            yield _changes(pa.Table.from_batches(rest), own, cells, rounds)

    found = together.mapInArrow(run, "grp string, snapshot_no int, key string, change_kind string")
    return found.withColumn("grp", F.when(F.col("grp") != "\0", F.col("grp")))
