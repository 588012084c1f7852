"""Texts cut off by field limits or broken transfers, found by a vocabulary trie, length and context.

A text that ends as a sentence does is whole. What ends otherwise may be cut, or be a headline, a date line or an
address. Evidence is gathered for each such text, and any of it, in this order, says that it was cut (``why``):

* ``trie``. Words inside texts and titles make the vocabulary, and all their prefixes the nodes of its trie, kept as
  a table (node, is a word, goes on), so the trie is as distributed as the corpus. A last word that is no word of the
  vocabulary but a node that goes on was cut inside.
* ``length``. Lengths at which a source's unended texts pile up, in characters or bytes, are its field limits; an unended
  text of that length was cut.
* ``address``. A web or mail address at the end that begins a longer one was cut. A text that ends with any other address is
  whole, unless it has a limit's length.
* ``begun``. A run of two or three last words whose last word, taken as the beginning of a longer one, is more often gone
  on with than met whole: the text was cut inside a word though what is left is a word too.
* ``mark``. A mark of omission, a broken character or entity, an open bracket, or a mark after which no sentence ends.
* ``context``. Of the last words (8, 5, 3, 2, 1) the longest run that is common enough is taken; where the corpus goes
  on after it more often than different texts end with it, the text was cut.

Digits count by number only, months alike; text means summaries here, since titles are edited at their ends. A text that
equals the record's own title is whole, and so is one whose last three words or more end some title and are never
gone on with inside a text. What has a mark is looked up in the trie and the limits without it.

The corpus is read twice: for the ends, and for what follows them. The second pass counts only runs that pass a
Bloom filter of the ends. It has sixteen bits for each of them, at most ``2 ** MOST_BITS`` (32 MB, enough for 16 million
different ends; with four times as many one run in seven passes that need not). Counts are exact whatever passes.

Null, empty and blank texts are no records here. Look-alike characters, widths and invisible characters are undone
before anything is compared. Texts are read whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callweave.llm.canon import clean
from callweave.session import settle

RUNS = (1, 2, 3, 5, 8)
LEAST_BITS, MOST_BITS = 12, 28
#: A run counts as common from this many ends and continuations.
COMMON = 4

# Marks of omission with what sites put behind them, abbreviations that end no sentence, sentence ends.
OMITTED = re.compile(
    r"(?:\s*(?:\.\.\.|\[\s*\.\.\.\s*\]|\(\s*\.\.\.\s*\)|…)\s*(?:read\s+more|more|continue\s+reading|see\s+more|weiterlesen|lire\s+la\s+suite|leer\s+más|続きを読む|»|>+|→)?"
    r"|\s+\[?\(?(?:read\s+more|more|cont(?:inued|\.))\)?\]?(?:\s*(?:»|>+|→))?|\s*\((?:more|read\s+more|cont(?:inued|\.))\)|�+)\s*$",
    re.I,
)
#: Texts without these have no mark of omission.
_MAY_OMIT = re.compile(r"\.\.\.|…|�|more|cont", re.I)
_BARE_MORE = re.compile(r"(?:^|[\s(\[])more$", re.I)
ABBREVIATIONS = re.compile(r"(?:^|[\s(\[])(?:e\.\s?g|i\.\s?e|vs|approx|cf|z\.\s?B|d\.\s?h|bzw|ca|p\.\s?ex|resp|incl|esp)\.$", re.I)
_MORE = re.compile(r"(?:\.\.\.|\]|\))\s*(?:read\s+)?more|\((?:read\s+)?more|read\s+more$", re.I)
_NEXT = re.compile(r"(?<=[.!?。])\s")
_ENDED = re.compile(r"[.!?。][)\]}\"'”’»」』]*$")
_ADDRESS = re.compile(r"(?:https?://|www\.)[^\s/]+/\S+$|\S+@\S+\.\w+$|(?:^|\s)[a-z0-9][a-z0-9\-]*(?:\.[a-z][a-z0-9\-]+){2,}$")
_OPEN_END = re.compile(r"[,;:(\[{\-–—/&'’\"«“‘、，；：「（]$")
_MONTHS = frozenset("January February March April May June July August September October November December".split())
_PLAIN = r"[぀-ヿ㐀-鿿豈-﫿]|[^\W\d_぀-ヿ㐀-鿿豈-﫿]+|\d+|[^\w\s]"
_SIMPLE, _TOKEN = re.compile(_PLAIN), re.compile(r"https?://\S+|[A-Za-z0-9][\w\-]*(?:\.[A-Za-z][\w\-]+){2,}|" + _PLAIN)
#: Texts without these hold no address, which saves the longer pattern.
_MAY_ADDRESS = re.compile(r"://|[a-z0-9]\.[a-z][a-z0-9\-]")


class _Forms(dict):
    """The form of a token: numbers as so many noughts, months alike."""

    def __missing__(self, t: str) -> str:
        if len(self) > 500_000:
            self.clear()
        form = self[t] = "0" * len(t) if t.isdigit() else "May" if t in _MONTHS else t
        return form


_forms = _Forms()


def tokens(text: str) -> list[str]:
    """Words, numbers (as so many noughts), single characters of scripts without blanks, and marks."""
    return list(map(_forms.__getitem__, (_TOKEN if _MAY_ADDRESS.search(text) else _SIMPLE).findall(text)))


def _id(token: str) -> int:
    return xxhash.xxh3_64_intdigest(token)


def beginnings(token: str, least: int) -> list[int]:
    """The ids of a word's beginnings of ``least`` characters or more; long words are hashed on, not copied."""
    if len(token) <= 64:
        return [_id(token[:n]) for n in range(least, len(token))]
    out, h = [], xxhash.xxh3_64(token[: least - 1])
    for c in token[least - 1 : -1]:
        h.update(c)
        out.append(h.intdigest())
    return out


def _mix(h: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    h = h + (ids ^ np.uint64(n * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xBF58476D1CE4E5B9 + 2 * n)
    return h ^ (h >> np.uint64(29))


def _seal(h: np.ndarray, n: int) -> np.ndarray:
    return h * np.uint64(0x94D049BB133111EB) + np.uint64(n)


def run_hashes(ids: np.ndarray) -> dict[int, np.ndarray]:
    """For each length in RUNS, the hash of the run of tokens that ends at each place (wrapping at the left edge)."""
    out, h = {}, np.zeros(len(ids), np.uint64)
    for n in range(1, max(RUNS) + 1):
        h = _mix(h, np.roll(ids, n - 1) if n > 1 else ids, n)
        if n in RUNS:
            out[n] = _seal(h, n)
    return out


def last_runs(last: list[str]) -> list[int | None]:
    """``run_hashes`` for the run at the end of a few tokens, as signed numbers; null where there are too few."""
    out, h, full = [], 0, (1 << 64) - 1
    for n in range(1, max(RUNS) + 1):
        if n <= len(last):
            h = (h + (_id(last[-n]) ^ (n * 0x9E3779B97F4A7C15 & full)) * (0xBF58476D1CE4E5B9 + 2 * n)) & full
            h ^= h >> 29
        if n in RUNS:
            sealed = (h * 0x94D049BB133111EB + n) & full
            out.append(None if n > len(last) else sealed - (1 << 64) if sealed >> 63 else sealed)
    return out


def begun_hashes(begun: np.ndarray, before: np.ndarray, before2: np.ndarray) -> dict[int, np.ndarray]:
    """The hashes of runs of two and three whose last word is ``begun``."""
    h = _mix(_mix(np.zeros(len(begun), np.uint64), begun, 1), before, 2)
    return {2: _seal(h, 2), 3: _seal(_mix(h, before2, 3), 3)}


def without_mark(text: str) -> str:
    """A text without a mark of omission at its end."""
    return OMITTED.sub("", text) if _MAY_OMIT.search(text) else text


def last_tokens(text: str) -> list[str]:
    """The last tokens of a text, as many as the longest run has: the text is tokenized from a blank on behind which there are enough."""
    size = 256
    while True:
        at = text.rfind(" ", 0, max(0, len(text) - size)) + 1
        found = tokens(text[at:])
        if not at or len(found) >= max(RUNS):
            return found[-max(RUNS) :]
        size *= 4


def _verdict(text: str) -> str:
    """'cut', 'whole' or 'ask', by what stands at the end."""
    if text[-1] not in ".!?。" or text[-3:] == "...":
        if _MAY_OMIT.search(text) and OMITTED.search(text) and not (_BARE_MORE.search(text) and not _MORE.search(text)):
            return "cut"
        if not _ENDED.search(text):
            return "cut" if _OPEN_END.search(text[-1]) or (at := text.rfind("&")) >= 0 and re.fullmatch(r"&#?\w{1,7}", text[at:]) else "ask"
    if text[-1] == "." and ABBREVIATIONS.search(text, max(0, len(text) - 12)):  # the longest has eight characters
        return "cut"
    if text[-1] not in ")]" and (at := text.rfind("(")) >= 0:
        return "cut" if at > text.rfind(")") and not _NEXT.search(text, at) else "whole"
    return "whole"


def ends(df: DataFrame, id_column: str, source: str, text: str, title: str) -> DataFrame:
    """A row for each non-blank text: its verdict, and for those not whole the last word and lengths, for those asked about the last runs."""
    kind = df.schema[id_column].dataType.simpleString()
    names = [id_column, "source", "verdict", "digest", "chars", "bytes", "word", "address", "runs"]
    schema = f"`{id_column}` {kind}, source string, verdict string, digest long, chars int, bytes int, word string, address boolean, runs array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, verdicts, digests, chars, sizes, words, addresses, runs = [], [], [], [], [], [], [], []
            for row, (value, head) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                if not value or not (own := clean(value)):
                    continue
                verdict, word, hashes = _verdict(own), None, None
                if verdict == "ask" and head:
                    head = clean(head)
                    if own == head or own == head.rstrip(" .!?-–"):
                        verdict = "whole"
                said = own
                if verdict == "ask":
                    last = last_tokens(own) or ["�"]
                    word = last[-1]
                    hashes = last_runs(last)
                elif verdict == "cut":
                    said = without_mark(own)
                    word = next((t for t in reversed(last_tokens(said)) if t[0].isalnum()), None)
                rows.append(row)
                verdicts.append(verdict)
                digests.append(xxhash.xxh3_64_intdigest(own) - (1 << 63))
                chars.append(len(said))
                sizes.append(len(said.encode("utf-8", "replace")))
                words.append(word)
                addresses.append(verdict == "ask" and bool(_ADDRESS.search(own)))
                runs.append(hashes)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(verdicts, pa.string()), pa.array(digests, pa.int64()), pa.array(chars, pa.int32()), pa.array(sizes, pa.int32()), pa.array(words, pa.string()), pa.array(addresses, pa.bool_()), pa.array(runs, pa.list_(pa.int64()))],
                names,
            )

    return df.select(F.col(id_column), F.col(source).cast("string"), text, title).mapInArrow(run, schema)


def bloom(hashes: DataFrame) -> bytes:
    """A filter over the column ``h``: two bits a hash, sixteen bits for each different hash, at most 2 ** MOST_BITS."""
    n = hashes.agg(F.approx_count_distinct("h")).first()[0]  # decides the size only
    bits = max(LEAST_BITS, min(MOST_BITS, int(16 * n).bit_length()))
    block = min(bits - 5, 14)
    places = hashes.select(F.explode(F.array(F.col("h").bitwiseAND((1 << bits) - 1), F.shiftrightunsigned("h", 64 - bits))).alias("bit"))
    words = places.groupBy(F.shiftright("bit", 5).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 31 as int))")).alias("bits"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            at, value = batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.uint64).astype(np.uint32)
            for b in np.unique(at >> block).tolist():
                here = at >> block == b
                held.setdefault(b, np.zeros(1 << block, np.uint32))[at[here] & ((1 << block) - 1)] = value[here]
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array([v.tobytes() for v in held.values()], pa.binary())], ["block", "held"])

    found = words.repartition(8, F.shiftright("word", block)).mapInArrow(pack, "block long, held binary").toArrow()  # 2 ** bits bits
    out = bytearray(1 << (bits - 3))
    for b, held in zip(found["block"].to_pylist(), found["held"].to_pylist(), strict=True):
        out[b << block + 2 : (b + 1) << block + 2] = held
    return bytes(out)


def _passes(filter_: np.ndarray, h: np.ndarray) -> np.ndarray:
    bits = 4 + len(filter_).bit_length()  # a power of two words of 32 bits
    hit = np.ones(len(h), bool)
    for bit in (h & np.uint64((1 << bits) - 1), h >> np.uint64(64 - bits)):
        hit &= (filter_[(bit >> np.uint64(5)).astype(np.int64)] >> (bit & np.uint64(31)).astype(np.uint32)) & np.uint32(1) == 1
    return hit


def what_follows(df: DataFrame, text: str, title: str, filter_: bytes) -> DataFrame:
    """(word, h, n, whole, begun): a row for each distinct word inside the texts, and for each asked-for run how often
    text follows it (n), how many titles end with it (whole), and how often a longer word stands where its last word
    does (begun). Marks of omission are not text."""
    shared = df.sparkSession.sparkContext.broadcast(filter_)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.frombuffer(shared.value, np.uint32)
        ids: dict[str, int] = {}
        inside: set[str] = set()
        counts: Counter = Counter()
        closes: Counter = Counter()
        starts: Counter = Counter()
        begins: dict[str, np.ndarray] = {}

        def learn(new: list[str]) -> None:
            """The ids of words, and of their beginnings that some text ends with."""
            for t in new:
                ids[t] = _id(t)
            parts = [(t, i) for t in new if not t.startswith("http") for i in beginnings(t, 1 + (t[0] == "0"))]
            own = np.fromiter((i for _, i in parts), np.uint64, len(parts))
            ok = _passes(wanted, _seal(_mix(np.zeros(len(own), np.uint64), own, 1), 1))
            kept: dict[str, list[int]] = {}
            for (t, _), i, k in zip(parts, own.tolist(), ok.tolist(), strict=True):
                if k:
                    kept.setdefault(t, []).append(i)
            for t in new:
                begins[t] = np.array(kept.get(t, ()), np.uint64)

        def flush() -> pa.RecordBatch:
            words, runs = list(inside), list(counts | closes | starts)
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array(words + [None] * len(runs), pa.string()),
                    pa.array([None] * len(words) + runs, pa.int64()),
                    pa.array([1] * len(words) + [counts[r] for r in runs], pa.int64()),
                    pa.array([0] * len(words) + [closes[r] for r in runs], pa.int64()),
                    pa.array([0] * len(words) + [starts[r] for r in runs], pa.int64()),
                ],
                ["word", "h", "n", "whole", "begun"],
            )
            for held in (inside, counts, closes, starts, ids, begins):
                held.clear()
            return out

        def count(into: Counter, h: np.ndarray) -> None:
            h, times = np.unique(h[_passes(wanted, h)].astype(np.int64), return_counts=True)
            for key, k in zip(h.tolist(), times.tolist(), strict=True):
                into[key] += k

        def read(value: str) -> list[str]:
            value = value if value.isascii() else clean(value)
            return tokens(without_mark(value) if value[-1:] not in ".?!。" or value[-3:] == "..." else value)

        for batch in batches:
            step = max(1, min(4096, int(4e6 // (batch.nbytes / max(1, batch.num_rows) + 1))))  # about 4 MB of text
            for begin in range(0, batch.num_rows, step):
                some, flat, sizes = batch.slice(begin, step), [], []
                for value in some.column(0).to_pylist():
                    if value and (t := read(value)):
                        flat += t
                        sizes.append(len(t))
                texts = len(sizes)
                for value in some.column(1).to_pylist():
                    if value and (t := tokens(value if value.isascii() else clean(value))):
                        flat += t
                        sizes.append(len(t))
                if not flat:
                    continue
                distinct = list(set(flat))
                learn([t for t in distinct if t not in ids])
                code = dict(zip(distinct, range(len(distinct)), strict=True))
                at = np.fromiter(map(code.__getitem__, flat), np.int64, len(flat))
                codes = np.fromiter(map(ids.__getitem__, distinct), np.uint64, len(distinct))[at]
                length = np.array(sizes)
                last = np.cumsum(length) - 1
                place = np.arange(len(flat)) - np.repeat(last - length + 1, length)
                goes_on = np.ones(len(flat), bool)
                goes_on[last] = False
                heads = np.zeros(len(flat), bool)
                heads[last[texts:]] = True
                in_text = np.arange(len(flat)) < (last[texts - 1] + 1 if texts else 0)
                inside.update(map(distinct.__getitem__, np.unique(at[goes_on | heads]).tolist()))
                held = [begins[t] for t in distinct]
                many = np.fromiter(map(len, held), np.int64, len(held))
                first = np.cumsum(many) - many
                spots = np.repeat(np.arange(len(flat)), many[at])
                if len(spots):
                    within = np.arange(len(spots)) - np.repeat(np.cumsum(many[at]) - many[at], many[at])
                    begun = np.concatenate(held)[first[at[spots]] + within]
                    for n, h in begun_hashes(begun, codes[spots - 1], codes[spots - 2]).items():
                        count(starts, h[place[spots] >= n - 1])
                for n, h in run_hashes(codes).items():
                    for which, into in ((goes_on & in_text, counts), (heads, closes)):
                        count(into, h[which & (place >= n - 1)])
                if len(inside) + len(counts) > 500_000:
                    yield flush()
        yield flush()

    return df.select(text, title).mapInArrow(run, "word string, h long, n long, whole long, begun long")


def trie(words: DataFrame, asked: DataFrame) -> DataFrame:
    """The nodes of the trie of the column ``word`` that are asked for (column ``node``): node, is_word, goes_on."""
    nodes = words.select(F.explode(F.expr("transform(sequence(1, length(word)), i -> struct(substring(word, 1, i) as node, i = length(word) as is_word))")).alias("x")).select("x.*")
    return nodes.join(asked.distinct(), "node", "left_semi").groupBy("node").agg(F.max("is_word").alias("is_word"), F.max(~F.col("is_word")).alias("goes_on"))


def limits(asked: DataFrame) -> DataFrame:
    """(source, measure, limit): lengths at which the unended texts of a source pile up.

    A length is a limit where it holds, with the one below it (a blank cut away), at least a tenth of the source's
    distinct unended texts, ten at least, eight times as many as the lengths near it, and their last words differ (texts
    that all end in a date may be equally long, too).
    """
    each = asked.select("source", "digest", F.coalesce(F.col("runs")[RUNS.index(3)], F.col("runs")[0]).alias("tail"), F.explode(F.create_map(F.lit("chars"), F.col("chars"), F.lit("bytes"), F.col("bytes"))).alias("measure", "size"))
    # Exact counts: of different texts and of different last words, each by a distinct of its own kind.
    place = ["source", "measure", "size"]
    texts = each.select(*place, "digest").distinct().groupBy(*place).agg(F.count("*").alias("n"))
    tails = each.select(*place, "tail").distinct().groupBy(*place).agg(F.count("tail").alias("tails"))
    sizes = texts.join(tails, place)
    line = Window.partitionBy("source", "measure").orderBy("size")  # one row for each length that occurs
    near = line.rangeBetween(-12, 12)
    sizes = sizes.withColumns({
        "all": F.sum("n").over(Window.partitionBy("source", "measure")),
        "near": F.sum("n").over(near),
        "pile": F.col("n") + F.when(F.lag("size").over(line) == F.col("size") - 1, F.lag("n").over(line)).otherwise(0),
    })
    alone = F.col("pile") >= 8 * (F.col("near") - F.col("pile")) / 23
    return sizes.where((F.col("pile") >= 10) & (F.col("pile") >= 0.1 * F.col("all")) & (F.col("n") >= 0.4 * F.col("pile")) & (F.col("tails") >= F.greatest(F.lit(6.0), 0.05 * F.col("pile"))) & alone).select("source", "measure", F.col("size").alias("limit"))


def find_cut(df: DataFrame, id_column: str, source: str, text: str, title: str) -> DataFrame:
    """A row for each non-blank text: ``id_column``, ``source``, ``is_cut``, ``why`` (the first evidence), ``evidence`` (all of it)."""
    found = settle(ends(df, id_column, source, text, title))
    asked = found.where("verdict = 'ask'")
    runs = asked.select(id_column, "digest", F.posexplode("runs").alias("k", "h")).where("h is not null")
    follows = settle(what_follows(df, text, title, bloom(runs.select("h").distinct())))
    on = follows.where("h is not null").groupBy("h").agg(F.sum("n").alias("on"), F.sum("whole").alias("whole"), F.sum("begun").alias("begun"))
    off = runs.select("h", "digest").distinct().groupBy("h").agg(F.count("*").alias("off"))
    none = F.lit(0)
    known = off.join(on, "h", "left").select("h", (F.col("off") + F.coalesce("whole", none)).alias("off"), F.coalesce("whole", none).alias("whole"), F.coalesce("on", none).alias("on"), F.coalesce("begun", none).alias("begun"))
    pair, three = RUNS.index(2), RUNS.index(3)
    inner = F.col("k").isin(pair, three) & (F.col("on") + F.col("off") + F.col("begun") >= COMMON)
    context = (
        runs.join(known, "h").groupBy(id_column).agg(
            F.max(F.when((F.col("on") + F.col("off") >= COMMON) | (F.col("k") == 0), F.struct("k", "on", "off"))).alias("c"),
            F.max(F.when(inner, F.struct("k", "begun", (F.col("on") + F.col("off")).alias("met")))).alias("b"),
            F.max((F.col("k") >= three) & (F.col("whole") > 0) & (F.col("on") == 0)).alias("titled"),
        )
        .select(id_column, F.col("c.on").alias("on"), F.col("c.off").alias("off"), F.coalesce(F.col("b.begun") > F.col("b.met"), F.lit(False)).alias("begun"), "titled")
    )
    unended = found.where("verdict <> 'whole'")
    nodes = trie(follows.where("word is not null").select("word").union(asked.where("address").select("word")).distinct(), unended.select(F.col("word").alias("node"))).withColumnRenamed("node", "word")
    most = limits(asked)
    at_limit = (
        unended.select(id_column, "source", F.explode(F.create_map(F.lit("chars"), F.col("chars"), F.lit("bytes"), F.col("bytes"))).alias("measure", "size"))
        .join(most, ["source", "measure"]).where("size between limit - 1 and limit").select(id_column, F.lit(True).alias("at_limit")).distinct()
    )
    told = unended.select(id_column, "source", "verdict", "word", "address").join(nodes, "word", "left").join(context, id_column, "left").join(at_limit, id_column, "left")
    no = F.lit(False)
    marked, address, titled, goes_on = F.col("verdict") == "cut", F.col("address"), F.coalesce("titled", no), F.coalesce("goes_on", no)
    plain = marked | ~address & ~titled
    evidence = {
        "trie": plain & ~F.coalesce("is_word", no) & goes_on,
        "length": F.coalesce("at_limit", no),
        "address": address & goes_on,
        "begun": plain & F.coalesce("begun", no),
        "mark": marked,
        "context": plain & F.coalesce(F.col("on") > F.col("off"), no),
    }
    told = told.select(id_column, "source", F.array_compact(F.array(*[F.when(v, k) for k, v in evidence.items()])).alias("evidence"))
    whole = found.where("verdict = 'whole'").select(id_column, "source", F.array().cast("array<string>").alias("evidence"))
    return whole.unionByName(told).select(id_column, "source", (F.size("evidence") > 0).alias("is_cut"), F.try_element_at("evidence", F.lit(1)).alias("why"), "evidence")


def cut_rates(cut: DataFrame) -> DataFrame:
    """For each source its non-blank texts, how many of them are cut, and the share."""
    return cut.groupBy("source").agg(F.count("*").alias("n_texts"), F.count_if("is_cut").alias("n_cut")).withColumn("share", F.round(F.col("n_cut") / F.col("n_texts"), 6))
