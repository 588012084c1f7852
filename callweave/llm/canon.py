"""Freely typed values mapped to the entries of a reference list: a BK-tree under the Levenshtein metric.

The keys of the tree are the names and aliases of the entries in a plain form (compatibility forms, case, accents of
Latin letters, punctuation and a leading article do not count). A typed value gives one or more readings: the whole
of it, and what is left without quotes, without a bracket or a descriptive tail at its end, without the name of a
publisher before it, and with an inverted heading turned round. The tree returns every key within the threshold of each reading; the triangle inequality prunes. The
winner is the nearest key; if the nearest keys belong to different entries, the value means none of them.

A second tree holds the initials of the keys' big words. A value whose words are cut short is looked up in it by its own
initials, and of the keys that come back those fit in which every word begins as the value's does: an exact check of what
the tree returned. They count after exact hits of the first tree and before hits with errors.

A swap of neighbouring letters counts as one typing error, though it is two steps of the metric: the tree is asked
for twice the errors allowed, and what it returns is counted exactly.

A list of at most ``broadcast_entries`` entries is one tree in every worker. A longer list is cut into shards, each
with its own tree; every distinct value meets every shard, and the winners of the shards merge.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Container, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callweave.llm.looks import INVISIBLE, LOOK_ALIKES
from callweave.session import settle

# Words that abbreviated titles leave out, and tails that describe an edition and not the title.
SMALL_WORDS = frozenset("a an and de der des die du et for für fur für in la le les of on the to und y".split())
TAILS = re.compile(
    r"\s*[,:;–—\-]\s*(?:(?:the\s+)?special\s+(?:issues?|sections?|collections?)|open\s+access|an?\s+international\s+journal|electronic\s+resource"
    r"|online(?:\s+edition)?|print(?:\s+edition)?|\w+\s+edition|new\s+series|(?:19|20)\d\d)\s*$",
    re.I,
)
_UNSEEN = re.compile(f"[{INVISIBLE}]")
_HAS_ALIKE = re.compile("[" + "".join(LOOK_ALIKES) + "]")
_ALIKE = str.maketrans(LOOK_ALIKES)
_BRACKET = re.compile(r"\s*[(\[（［【][^()\[\]（）［］【】]*[)\]）］】]\s*$")
_QUOTES = re.compile(r"^[«»\"'“”„‘’‹›「」『』]+|[«»\"'“”„‘’‹›「」『』]+$")
_MARKS = re.compile(r"[^\w]|_")
_ACCENTS = re.compile("[\u0300-\u036f]")
_HEAD = re.compile(r"^(.+?)\s*(?:/|:|\s[-–—])\s+(.+)$")
NONE = -1
#: Values that one task looks up in one shard.
BLOCK_VALUES = 50_000


def clean(text: str) -> str:
    """Without what cannot be seen, in compatibility form, look-alike letters made Latin, outer blanks removed."""
    if text.isascii():
        return text.strip()
    text = unicodedata.normalize("NFKC", _UNSEEN.sub("", text))
    return (text.translate(_ALIKE) if _HAS_ALIKE.search(text) else text).strip()


def plain(text: str) -> str:
    """The form in which values are compared."""
    text = unicodedata.normalize("NFC", _ACCENTS.sub("", unicodedata.normalize("NFD", clean(text).casefold())))
    words = _MARKS.sub(" ", text.replace("&", " and ")).split()
    if len(words) > 1 and words[0] == "the":
        words = words[1:]
    return " ".join(words)


def levenshtein(peq: dict[str, int], n: int, text: str) -> int:
    """Steps between a word (its bit masks ``peq`` and length ``n``) and ``text``: bit-parallel."""
    if not n:
        return len(text)
    mask, last = (1 << n) - 1, 1 << (n - 1)
    pv, mv, score, get = mask, 0, n, peq.get
    for ch in text:
        eq = get(ch, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv)
        mh = pv & xh
        if ph & last:
            score += 1
        elif mh & last:
            score -= 1
        ph = (ph << 1) | 1
        pv = ((mh << 1) | ~(xv | ph)) & mask
        mv = ph & xv & mask
    return score


def masks(text: str) -> dict[str, int]:
    peq: dict[str, int] = {}
    for i, ch in enumerate(text):
        peq[ch] = peq.get(ch, 0) | 1 << i
    return peq


def typing_errors(a: str, b: str) -> int:
    """Insertions, deletions, changes and swaps of neighbours between ``a`` and ``b`` (Damerau's distance)."""
    seen: dict[str, int] = {}
    most = len(a) + len(b)
    d = [[most] * (len(b) + 2) for _ in range(len(a) + 2)]
    for i in range(len(a) + 1):
        d[i + 1][1] = i
    for j in range(len(b) + 1):
        d[1][j + 1] = j
    for i in range(1, len(a) + 1):
        match = 0
        for j in range(1, len(b) + 1):
            k, m, cost = seen.get(b[j - 1], 0), match, 1
            if a[i - 1] == b[j - 1]:
                cost, match = 0, j
            d[i + 1][j + 1] = min(d[i][j] + cost, d[i + 1][j] + 1, d[i][j + 1] + 1, d[k][m] + (i - k - 1) + 1 + (j - m - 1))
        seen[a[i - 1]] = i
    return d[-1][-1]


def allowed(n: int) -> int:
    """Typing errors allowed in a value of ``n`` characters."""
    return 0 if n < 5 else 1 if n < 10 else 2


def big(key: str) -> list[str]:
    """The words of a key that abbreviated titles keep."""
    words = key.split(" ")
    return [w for w in words if w not in SMALL_WORDS] or words


def initials(key: str) -> str:
    return "".join(w[0] for w in big(key))


class Tree[T]:
    """A BK-tree of keys, each with what it stands for."""

    def __init__(self, keys: list[tuple[str, T]]):
        self.ids: dict[str, set[T]] = {}
        for key, i in keys:
            if key:
                self.ids.setdefault(key, set()).add(i)
        self.root: tuple[str, dict] | None = None
        for key in sorted(self.ids):
            self._insert(key)

    def _insert(self, key: str) -> None:
        if self.root is None:
            self.root = (key, {})
            return
        node, peq = self.root, masks(key)
        while True:
            d = levenshtein(peq, len(key), node[0])
            child = node[1].get(d)
            if child is None:
                node[1][d] = (key, {})
                return
            node = child

    def within(self, key: str, radius: int) -> list[tuple[int, str]]:
        """Every (distance, key) at most ``radius`` steps away."""
        if self.root is None:
            return []
        peq, n, out, todo = masks(key), len(key), [], [self.root]
        while todo:
            own, children = todo.pop()
            d = levenshtein(peq, n, own)
            if d <= radius:
                out.append((d, own))
            if children:
                for step in range(max(1, d - radius), d + radius + 1):
                    if (child := children.get(step)) is not None:
                        todo.append(child)
        return out


def written_out(tree: Tree[str], key: str) -> list[str]:
    """Keys of which ``key`` is an abbreviation: the same big words in order, each cut short or whole. ``tree`` has the keys by their initials."""
    words = big(key)
    near = {full for _, found in tree.within(initials(key), 0) for full in tree.ids[found]}
    return sorted(full for full in near if len(own := big(full)) == len(words) and all(f.startswith(w) for f, w in zip(own, words, strict=True)))


def readings(value: str, publishers: Container[str]) -> list[str]:
    """The plain readings of a typed value, the most literal first."""
    out: dict[str, None] = {}
    todo = [clean(value)]
    met = set(todo)
    while todo:
        text = todo.pop(0)
        out[plain(text)] = None
        more = [_QUOTES.sub("", text), _BRACKET.sub("", text), TAILS.sub("", text), text.rstrip(" .,;:")]
        if (m := _HEAD.match(text)) and plain(m.group(1)) in publishers:
            more.append(m.group(2))
        if text.count(",") == 1:
            tail, head = text.split(",")
            if head.strip() and tail.strip():
                head = head.strip()
                more.append(head + " " + re.sub(r"^\s*the\s+", "", tail, flags=re.I) if not re.search(r"\b(?:of|on|in|for|de|du|des)(?:\s+the)?$", head, re.I) else head + " " + tail.strip())
        for t in more:
            if (t := t.strip()) and t not in met:
                met.add(t)
                todo.append(t)
    return [k for k in out if k]


class _Asked(list):
    """Holds whatever is looked for in it, and keeps it."""

    def __contains__(self, key: object) -> bool:
        self.append(key)
        return True


def heads(value: str) -> list[str]:
    """What stands where a publisher may stand, in any reading of a value."""
    asked = _Asked()
    readings(value, asked)
    return sorted(set(asked))


class Matcher:
    """The best entries for typed values, with a worker's memory of values."""

    def __init__(self, entries: list[dict], remembered: int = 200_000):
        keys = [(plain(t), e["id"]) for e in entries for t in [e["name"], *([] if e["aliases"] is None else e["aliases"])] if t]
        self.tree = Tree(keys)
        self.by_initials = Tree([(initials(k), k) for k in self.tree.ids])
        self.publishers = frozenset(plain(e["publisher"]) for e in entries if e["publisher"])
        self.known: dict[str, tuple[int, list[int]]] = {}
        self.remembered = remembered

    def best(self, value: str) -> tuple[int, list[int]]:
        """(errors, ids of the nearest entries); no id where nothing is within the threshold."""
        if (own := self.known.get(value)) is None:
            if len(self.known) > self.remembered:
                self.known.clear()
            own = self.known[value] = self._best(value)
        return own

    def _best(self, value: str) -> tuple[int, list[int]]:
        (_, _, errors), ids = self.ranked(value, self.publishers)
        return errors, ids

    def ranked(self, value: str, publishers: Container[str]) -> tuple[tuple[int, int, int], list[int]]:
        """((kind, reading, errors), ids of the nearest entries): exact hits, then abbreviations, each by the place of the reading, then errors."""
        keys = readings(value, publishers)
        tree = self.tree
        for at, key in enumerate(keys):
            if hits := tree.within(key, 0):
                return (0, at, 0), sorted(tree.ids[hits[0][1]])
        for at, key in enumerate(keys):
            if full := {i for k in written_out(self.by_initials, key) for i in tree.ids[k]}:
                return (1, at, 0), sorted(full)
        found: dict[int, int] = {}
        for key in keys:
            most = allowed(len(key))
            if not most:
                continue
            for _, near in tree.within(key, 2 * most):
                if (e := typing_errors(key, near)) <= min(most, allowed(len(near))):
                    for i in tree.ids[near]:
                        found[i] = min(e, found.get(i, e))
        least = min(found.values(), default=0)
        return (2, 0, least), sorted(i for i, e in found.items() if e == least)

    def __call__(self, value: str) -> int:
        ids = self.best(value)[1]
        return ids[0] if len(ids) == 1 else NONE


def _entries(reference: DataFrame) -> list[dict]:
    return [r.asDict() for r in reference.collect()]


def map_values(
    df: DataFrame, id_column: str, single: str, several: str, reference: DataFrame, broadcast_entries: int = 20_000, shard_entries: int = 5_000,
) -> DataFrame:
    """(id_column, pos, id): the entry meant by each non-blank value that is not itself the name of an entry, -1 for none.

    ``pos`` is 0 for the column ``single`` and i for the i-th item of ``several``, from 1; null and blank items keep
    their places and give no row. ``reference`` has the columns id, name, publisher, aliases.
    """
    kind = df.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, pos int, value string, id long"
    names = ["pos", "value", "id"]
    n = reference.count()
    if n <= broadcast_entries:
        shared = df.sparkSession.sparkContext.broadcast(_entries(reference))  # at most broadcast_entries entries
    else:
        shared = None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = exact = None
        if shared is not None:
            match, exact = Matcher(shared.value), {e["name"] for e in shared.value}
        for batch in batches:
            rows, places, values, ids = [], [], [], []
            for row, (one, more) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                for at, v in enumerate((one, *(more or ()))):
                    if v is None or exact is not None and v in exact or not clean(v):
                        continue
                    rows.append(row)
                    places.append(at)
                    values.append(v)
                    ids.append(match(v) if match else None)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(places, pa.int32()), pa.array(values, pa.string()), pa.array(ids, pa.int64())], [id_column, *names])

    typed = df.select(id_column, single, several).mapInArrow(run, schema)
    if shared is not None:
        return typed.select(id_column, "pos", "id")
    typed = typed.drop("id").join(reference.select(F.col("name").alias("value")).distinct(), "value", "left_anti")
    return typed.join(shard_winners(typed.select("value").distinct(), reference, -(-n // shard_entries)), "value").select(id_column, "pos", "id")


def known_heads(values: DataFrame, reference: DataFrame) -> DataFrame:
    """(value, heads): which of a value's possible publishers the reference has, whatever shard they are in."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [(v, h) for v in batch.column(0).to_pylist() for h in heads(v)]
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.string()) for k in (0, 1)], ["value", "head"])

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([plain(p) for p in batch.column(0).to_pylist() if p], pa.string())], ["head"])

    publishers = reference.select("publisher").distinct().mapInArrow(names, "head string").distinct()
    return values.select("value").mapInArrow(split, "value string, head string").join(publishers, "head").groupBy("value").agg(F.collect_set("head").alias("heads"))


def shard_winners(values: DataFrame, reference: DataFrame, shards: int) -> DataFrame:
    """(value, id) by ``shards`` trees: every distinct value meets every shard in blocks of about ``BLOCK_VALUES``, the winners
    merge by rank."""
    values = settle(values)
    blocks = max(1, -(-values.count() // BLOCK_VALUES))
    cut = reference.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    told = values.join(known_heads(values, reference), "value", "left")
    asked = told.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "value", "heads", F.pmod(F.xxhash64("value"), F.lit(blocks)).cast("int").alias("block"))
    copies = cut.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        match = Matcher(right.to_dict("records"))
        won = [(v, *match.ranked(v, frozenset(() if h is None else h))) for v, h in zip(left["value"], left["heads"], strict=True)]
        return pd.DataFrame([(v, *rank, i) for v, rank, ids in won for i in ids], columns=["value", "kind", "reading", "errors", "id"])

    won = asked.groupBy("shard", "block").cogroup(copies.groupBy("shard", "block")).applyInPandas(search, "value string, kind int, reading int, errors int, id long")
    best = won.groupBy("value", "kind", "reading", "errors").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
    best = best.groupBy("value").agg(F.min(F.struct("kind", "reading", "errors", "lo", "hi")).alias("b"))
    return values.join(best, "value", "left").select("value", F.when(F.col("b.lo") == F.col("b.hi"), F.col("b.lo")).otherwise(F.lit(NONE).cast("long")).alias("id"))
