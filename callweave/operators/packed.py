"""Several values packed in one field: split into one value per row by minimum description length.

A field is an entry of an array column. Each entry is parsed under every dialect (delimiter, quoting) whose marks
it holds, under the dialect that mixes all delimiters and under the one that splits nowhere. Every parse is scored by
the bits that a code fitted to the whole corpus needs for it: its dialect, and its values. The cheapest parse
wins, ties go to the parse with more values. No mark, dialect or kind of value has a charge of its own.

Codes. A value that the corpus has twice or more costs ``-log2(count / all)`` bits; any other an escape (its
share is that of the values met once) and its characters, each by its own share among all characters of values, so
that a delimiter is dear exactly where values seldom hold it. They are first fitted to the entries that
have one parse only; then, ``rounds`` times, the other entries are parsed (each distinct one once) and all codes fitted
again to what was chosen. Value counts are added up in Spark and sent to executors as a table of ``ROWS`` rows of hash
slots: two slots a row for each distinct value, at most ``2 ** MOST_BITS``, four bytes a slot. A slot holds the code and 24
bits of the hash of the commonest of its values, so an unknown value is taken for a known one once in ten million
times; a rare value whose slots are all held by commoner ones counts as new (one in 40 while the table grows, up to two
million distinct values; at four million one in six, so that there the rarest values cost their escape).

Cases: a null array, a null or blank entry gives no row; a repeated value is kept; ``pos`` counts from 0 through
the whole array; extra columns of the input are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callweave.session import settle

# The delimiters, the pairs of quotes, and the labels put before a line of keywords.
DELIMITERS = (",", ";", "；", "，", "、", "|", "·", "•", "\n", "\t", " / ", " : ")
QUOTES = {'"': '"', "'": "'", "“": "”", "‘": "’", "«": "»", "„": "“"}
LABEL = re.compile(
    r"^\s*(?:key[\s-]*words?|index\s+terms|subject\s+terms|mots[\s-]*cl[ée]s|schlagw[öo]rter|schl[üu]sselw[öo]rter"
    r"|palabras\s+clave|parole\s+chiave|キーワード)(?:\s*[:：]|\s+[-–—](?=\s))\s*",
    re.I,
)

_SINGLE = "".join(d for d in DELIMITERS if len(d) == 1)
_SPACED = {" / ": re.compile(r"(?:(?<=\s)|^)/|/(?=\s|$)"), " : ": re.compile(r"(?<=\s):")}
_MARKS = re.compile("[" + re.escape(_SINGLE + "".join(QUOTES) + "".join(QUOTES.values())) + r"()\[\]]|\s[/:]|/\s|^/|/$")
_BLANKS, _ODD_BLANKS = re.compile(r"\s+"), re.compile(r"\s\s|[^\S ]")
_LINES = re.compile(r"[\n\t]")
_ANY_QUOTE = re.compile("[" + "".join(QUOTES) + "]")
_BRACKETS = re.compile(r"\([^()]*\)")
_NUMBER = re.compile(r"(?<=\d),(?=\d{3}(?!\d))")
_ALL = re.compile("[" + re.escape(_SINGLE) + r"]|(?:(?<=\s)|^)/|/(?=\s|$)|(?<=\s):")
#: Delimiters inside what is protected move to this private block while a line is cut.
_HIDE = {ord(c): 0xF0000 + i for i, c in enumerate(_SINGLE + "/:")}
_SHOW = {v: k for k, v in _HIDE.items()}
#: Rows of the count table and bits of its longest row; entries that a worker remembers.
ROWS, MOST_BITS, CACHED = 4, 22, 200_000
#: Characters that are taken to occur once before any is counted.
ALPHABET = 128
MIXED, WHOLE, LISTED = "mixed", "whole", "listed"


def _quoted(delimiter: str | None) -> re.Pattern:
    """Quoted text that fills a whole piece: from a delimiter or the start to a delimiter or the end."""
    stop = "[" + re.escape(_SINGLE) + "]" if delimiter is None or len(delimiter) > 1 else re.escape(delimiter)
    edge = rf"(?:{stop}|\s[/:](?:\s|$))" if delimiter is None else (rf"\s{re.escape(delimiter.strip())}(?:\s|$)" if len(delimiter) > 1 else stop)
    before = rf"(?:^|(?<={stop})|(?<=\s[/:]\s))"
    bodies = "|".join(rf"{re.escape(a)}(?:[^{re.escape(b)}]|{re.escape(b)}{re.escape(b)})*{re.escape(b)}" for a, b in QUOTES.items())
    return re.compile(rf"{before}\s*(?:{bodies})(?=\s*(?:$|{edge}))")


_QUOTED = {d: _quoted(d) for d in (None, *DELIMITERS)}


def _undo(piece: str) -> str:
    """``piece`` without its quoting, with doubled quotes made single."""
    if len(piece) > 1 and (close := QUOTES.get(piece[0])) and piece[-1] == close:
        piece = piece[1:-1].replace(close * 2, close)
    return piece


def _hide(match: re.Match) -> str:
    return match.group().translate(_HIDE)


def parse(line: str, delimiter: str | None, quoting: bool, mixed: bool = False) -> tuple[str, ...]:
    """The values of ``line``; ``delimiter`` None splits nowhere, ``mixed`` at every delimiter. Line ends and tabs outside
    quotes and brackets are in no value."""
    text = line
    if quoting and _ANY_QUOTE.search(text):
        text = _QUOTED[None if mixed or delimiter is None else delimiter].sub(_hide, text)
    if "(" in text:
        text = _BRACKETS.sub(_hide, text)
    if "," in text:
        text = _NUMBER.sub(_hide, text)
    hidden = text is not line
    if mixed:
        pieces = _ALL.split(text)
    elif delimiter is None:
        pieces = _LINES.split(text)
    else:
        cut = _SPACED[delimiter].split if delimiter in _SPACED else lambda t: t.split(delimiter)
        pieces = [piece for line_ in _LINES.split(text) for piece in cut(line_)]
    out = []
    for piece in pieces:
        piece = (piece.translate(_SHOW) if hidden else piece).strip()
        if quoting and piece[:1] in QUOTES:
            piece = _undo(piece).strip()
        if piece:
            out.append(_BLANKS.sub(" ", piece) if _ODD_BLANKS.search(piece) else piece)
    return tuple(out)


def _line(entry: str) -> tuple[str, bool]:
    """The entry without label, and whether it is the printed form of a list."""
    text = entry.strip()
    if text[:1] in "kKiIsSmMpPキ":
        text = LABEL.sub("", text, count=1).strip()
    if len(text) > 1 and text[0] == "[" and text[-1] == "]" and text[1:-1].strip()[:1] in ('"', "'"):
        return text[1:-1].strip(), True
    return text, False


def finest(entry: str) -> tuple[str, ...]:
    """The parse at every delimiter, quotes and brackets kept whole; empty where nothing is left."""
    return _begin(entry)[1]


def _begin(entry: str) -> tuple[str | None, tuple[str, ...]]:
    """The entry's line if it has other parses than the finest, and that one."""
    text, listed = _line(entry)
    if listed:
        return None, tuple(p.replace("\\'", "'").replace('\\"', '"') for p in parse(text, ",", True))
    if not _MARKS.search(text):
        piece = _BLANKS.sub(" ", text).strip()
        return None, (piece,) if piece else ()
    found = parse(text, None, True, mixed=True)
    return text if found else None, found


def parses(entry: str) -> dict[tuple[str, ...], str]:
    """The distinct parses of an entry, the finest first, each with the simplest dialect that gives it."""
    text, best = _begin(entry)
    if text is None:
        return {best: LISTED if len(best) > 1 else WHOLE} if best else {}
    held = [d for d in DELIMITERS if d.strip(" ") in text]
    single = [d for d in held if d not in "\n\t"]
    found = {best: single[0] if len(single) == 1 else MIXED}
    quoting = (True, False) if any(q in text for q in QUOTES) and parse(text, None, False, mixed=True) != best else (True,)
    for q in quoting:
        tail = "" if q else " unquoted"
        for d in (None, *(single if len(single) > 1 else ())):  # with one delimiter the finest parse is its own
            own = parse(text, d, q)
            if own and found.get(own, MIXED) == MIXED:
                found[own] = (d or WHOLE) + tail
        if not q:
            found.setdefault(parse(text, None, False, mixed=True), MIXED + tail)
    return {p: d for p, d in found.items() if p}


def only_parse(entry: str) -> tuple[tuple[str, ...], str] | None:
    """The parse and dialect of an entry that has one only, an empty parse where nothing is left; None where there are several."""
    text, best = _begin(entry)
    if text is not None and (whole := parse(text, None, True)) and whole != best:
        return None
    options = parses(entry)
    return next(iter(options.items()), ((), WHOLE)) if len(options) < 2 else None


def _hash(value: str) -> int:
    """A signed hash of a value, case aside."""
    return xxhash.xxh3_64_intdigest(value.lower()) - (1 << 63)


def _slots(h: int, bits: int) -> list[int]:
    """The slot of a value's hash in each row, counted through all rows."""
    h += 1 << 63
    step, mask = (h >> 32) | 1, (1 << bits) - 1
    return [(r << bits) + (((h + r * step) >> 3) & mask) for r in range(ROWS)]


@dataclass
class Codes:
    """Code lengths in bits. ``table`` has those of values in quarter bits and part of their hash by slot, 0 where no value is known."""

    bits: int = 4
    table: bytes = b""
    escape: float = 1.0
    letters: dict[str, float] = field(default_factory=dict)
    rare_letter: float = 8.0
    stop: float = 3.0
    dialects: dict[str, float] = field(default_factory=dict)
    rare_dialect: float = 4.0


class _Letters(dict):
    """The bits of characters; those never counted are all rare."""

    def __init__(self, codes: Codes):
        super().__init__(codes.letters)
        self.rare = codes.rare_letter

    def __missing__(self, c: str) -> float:
        return self.rare


class Scorer:
    """The bits of values and parses under given codes, with a worker's memory."""

    def __init__(self, codes: Codes):
        self.codes, self.table = codes, np.frombuffer(codes.table or bytes(4 * ROWS << codes.bits), np.uint32)
        self.known: dict[str, float] = {}
        self.letters = _Letters(codes)
        self.least_letter = min([*codes.letters.values(), codes.rare_letter])

    def value(self, value: str) -> float:
        if (own := self.known.get(value)) is None:
            if len(self.known) > CACHED:
                self.known.clear()
            own = self.known[value] = self._value(value)
        return own

    def _value(self, value: str) -> float:
        spelled = self.codes.escape + self.codes.stop + sum(map(self.letters.__getitem__, value.lower()))
        found = self._found(value)
        return spelled if found is None else min(spelled, found)

    def _found(self, value: str) -> float | None:
        """The bits of a value that the table knows."""
        h = _hash(value)
        for s in _slots(h, self.codes.bits):
            held = int(self.table[s])
            if held and held & _PART == h & _PART:
                return (held >> 24) / 4
        return None

    def _least(self, value: str) -> float:
        """Bits that a value needs at least; not more than ``value`` gives."""
        if (own := self.known.get(value)) is not None:
            return own
        spelled = self.codes.escape + self.codes.stop + len(value) * self.least_letter
        found = self._found(value)
        return spelled if found is None else min(spelled, found)

    def cheapest(self, options: dict[tuple[str, ...], str]) -> tuple[str, ...]:
        """The parse with the shortest description; of equally short ones the finest. One more bit a value tells that it goes on."""
        if len(options) < 2:
            return next(iter(options), ())
        dialect, rare = self.codes.dialects.get, self.codes.rare_dialect
        best = None
        for p, d in options.items():
            fixed = dialect(d, rare) + len(p)
            if best is not None and fixed + sum(map(self._least, p)) > best[0] + 0.001:
                continue  # it cannot be cheaper
            own = round(fixed + sum(map(self.value, p)), 3), -len(p), p
            if best is None or own < best:
                best = own
        return best[2]


_PART = (1 << 24) - 1
_COUNTS = "kind string, key long, n long, entry string"
_COUNT_NAMES = ["kind", "key", "n", "entry"]


class _Counts:
    """What a worker counts: values by hash, characters of the distinct values, dialects; and the entries left open."""

    def __init__(self) -> None:
        self.values: Counter = Counter()
        self.letters: Counter = Counter()
        self.dialects: Counter = Counter()
        self.met: dict[str, int] = {}
        self.open: Counter = Counter()

    def add(self, values: tuple[str, ...], dialect: str, n: int) -> None:
        for v in values:
            if (h := self.met.get(v)) is None:
                h = self.met[v] = _hash(v)
                self.letters.update(v.lower())
                self.letters[""] += 1  # the end of a value
            self.values[h] += n
        self.dialects[dialect] += 1

    def full(self) -> bool:
        return len(self.values) + len(self.open) > 500_000

    def rows(self) -> pa.RecordBatch:
        keyed = [("value", k, n, None) for k, n in self.values.items()] + [("letter", ord(c) if c else -1, n, None) for c, n in self.letters.items()]
        all_ = keyed + [("dialect", None, n, d) for d, n in self.dialects.items()] + [("open", None, n, e) for e, n in self.open.items()]
        columns = list(zip(*all_, strict=True)) or [[], [], [], []]
        self.__init__()
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], _COUNT_NAMES)


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the entries with one parse, and the others."""
    counts = _Counts()
    known: dict[str, tuple[tuple[str, ...], str] | None] = {}
    for batch in batches:
        found = pc.value_counts(batch.column(0).flatten())
        for entry, n in zip(found.field(0).to_pylist(), found.field(1).to_pylist(), strict=True):
            if entry is None:
                continue
            if entry not in known:
                if len(known) > CACHED:
                    known.clear()
                known[entry] = only_parse(entry)
            if (own := known[entry]) is None:
                counts.open[entry] += n
            elif own[0]:
                counts.add(*own, n)
        if counts.full():
            yield counts.rows()
    yield counts.rows()


_OPEN = "entry string, n long, parses array<array<string>>, dialects array<string>"


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows (entry, n) with all their parses."""
    for batch in batches:
        options = [parses(e) for e in batch.column(0).to_pylist()]
        found = pa.array([list(map(list, o)) for o in options], pa.list_(pa.list_(pa.string())))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), found, pa.array([list(o.values()) for o in options], pa.list_(pa.string()))], ["entry", "n", "parses", "dialects"])


def _options(batch: pa.RecordBatch) -> Iterator[dict[tuple[str, ...], str]]:
    for found, dialects in zip(batch.column("parses").to_pylist(), batch.column("dialects").to_pylist(), strict=True):
        yield dict(zip(map(tuple, found), dialects, strict=True))


def _chosen(codes: Codes):
    """Counts of the cheapest parses of the rows (n, parses, dialects)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, scorer = _Counts(), Scorer(codes)
        for batch in batches:
            for options, n in zip(_options(batch), batch.column("n").to_pylist(), strict=True):
                own = scorer.cheapest(options)
                counts.add(own, options[own], n)
            if counts.full():
                yield counts.rows()
        yield counts.rows()

    return run


def _slot_table(values: DataFrame, total: int, distinct: int) -> tuple[int, bytes]:
    """(bits, table) for the rows (key, n) of values met twice or more."""
    bits = min(MOST_BITS, max(6, math.ceil(math.log2(2 * distinct + 1))))
    block = min(bits, 12)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            held = np.clip(np.round(4 * np.log2(total / n)), 1, 255).astype(np.int64) << 24 | keys & _PART
            slots = np.array([_slots(k, bits) for k in keys.tolist()], np.int64).reshape(-1)
            yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(np.repeat(held, ROWS))], ["slot", "held"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, np.ndarray] = {}
        for batch in batches:
            slots, held = batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.uint32)
            for b in np.unique(slots >> block).tolist():
                here = slots >> block == b
                blocks.setdefault(b, np.zeros(1 << block, np.uint32))[slots[here] & ((1 << block) - 1)] = held[here]
        yield pa.RecordBatch.from_arrays([pa.array(list(blocks), pa.int64()), pa.array([v.tobytes() for v in blocks.values()], pa.binary())], ["block", "held"])

    least = values.select("key", "n").mapInArrow(spread, "slot long, held long").groupBy("slot").agg(F.min("held").alias("held"))  # the commonest value
    found = least.repartition(8, F.shiftright("slot", block)).mapInArrow(pack, "block long, held binary").toArrow()  # four bytes a slot
    table = bytearray(4 * ROWS << bits)
    for b, held in zip(found["block"].to_pylist(), found["held"].to_pylist(), strict=True):
        table[b << block + 2 : (b + 1) << block + 2] = held
    return bits, bytes(table)


def _fit(counts: DataFrame) -> Codes:
    """Codes for what was counted."""
    held = settle(counts.where("kind <> 'open'").groupBy("kind", "key", "entry").agg(F.sum("n").alias("n")))
    values = held.where("kind = 'value'")
    total, known, once = values.agg(F.sum("n"), F.count_if(F.col("n") > 1), F.count_if(F.col("n") == 1)).first()
    small = held.where("kind <> 'value'").collect()  # a row a character of the alphabet and a dialect
    if not total:
        return Codes()
    letters = {chr(r["key"]) if r["key"] >= 0 else "": r["n"] for r in small if r["kind"] == "letter"}
    dialects = {r["entry"]: r["n"] for r in small if r["kind"] == "dialect"}
    bits, table = _slot_table(values.where("n > 1"), total, known) if known else (4, b"")
    share = lambda found, prior: {k: math.log2((sum(found.values()) + prior) / (n + 1)) for k, n in found.items()}
    rare = lambda found, prior: math.log2(sum(found.values()) + prior)
    code = share(letters, ALPHABET)
    return Codes(bits, table, math.log2((total + 1) / (once + 1)), code, rare(letters, ALPHABET), code.get("", 0.0), share(dialects, len(DELIMITERS)), rare(dialects, len(DELIMITERS)))


def fitted_codes(df: DataFrame, column: str, rounds: int = 2) -> tuple[Codes, DataFrame]:
    """The codes of ``column`` (array of strings), and the distinct entries that have several parses, with these."""
    gathered = settle(df.select(column).where(F.col(column).isNotNull()).mapInArrow(_gather, _COUNTS))
    open_ = settle(gathered.where("kind = 'open'").groupBy("entry").agg(F.sum("n").alias("n")).mapInArrow(_parsed, _OPEN))
    codes = _fit(gathered)
    for _ in range(rounds):
        codes = _fit(gathered.unionByName(open_.select("n", "parses", "dialects").mapInArrow(_chosen(codes), _COUNTS)))
    return codes, open_


def dialect_wins(df: DataFrame, column: str, rounds: int = 2) -> DataFrame:
    """For each dialect how many distinct entries with several parses it wins, and in how many it beats the finest parse."""
    codes, open_ = fitted_codes(df, column, rounds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(codes)
        for batch in batches:
            rows = []
            for options in _options(batch):
                own = scorer.cheapest(options)
                rows.append((options[own], int(own != next(iter(options)))))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64())], ["dialect", "coarser"])

    return open_.select("parses", "dialects").mapInArrow(run, "dialect string, coarser long").groupBy("dialect").agg(F.count("*").alias("entries"), F.sum("coarser").alias("coarser"))


class Splitter:
    """Values of entries by their cheapest parse; a worker's memory of the entries it has met."""

    def __init__(self, codes: Codes):
        self.scorer = Scorer(codes)
        self.known: dict[str, tuple[str, ...]] = {}

    def __call__(self, entries: list[str | None] | None) -> list[str]:
        out: list[str] = []
        known = self.known
        for entry in entries or ():
            if entry is None:
                continue
            if (own := known.get(entry)) is None:
                if len(known) > CACHED:
                    known.clear()
                own = known[entry] = self.scorer.cheapest(parses(entry))
            out += own
        return out


def shared_codes(df: DataFrame, column: str, rounds: int = 2):
    """A broadcast of the codes of ``column``: at most 4 * ROWS * 2 ** MOST_BITS bytes and a code a character of the alphabet."""
    return df.sparkSession.sparkContext.broadcast(fitted_codes(df, column, rounds)[0])


def unpack(df: DataFrame, id_column: str, column: str, rounds: int = 2) -> DataFrame:
    """One row for each value of ``column`` (array of strings): ``id_column``, ``pos`` int, ``keyword``.

    Two passes over the column, and ``rounds`` over the distinct entries that have several parses; rows are not shuffled.
    """
    shared = shared_codes(df, column, rounds)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values_of = Splitter(shared.value)
        for batch in batches:
            rows, places, values = [], [], []
            for row, entries in enumerate(batch.column(1).to_pylist()):
                own = values_of(entries)
                values += own
                rows += [row] * len(own)
                places += range(len(own))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(places, pa.int32()), pa.array(values, pa.string())],
                [id_column, "pos", "keyword"],
            )

    kind = df.schema[id_column].dataType.simpleString()
    return df.select(id_column, column).where(F.col(column).isNotNull()).mapInArrow(split, f"`{id_column}` {kind}, pos int, keyword string")
