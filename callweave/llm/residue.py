"""Template residue and error pages: labelled exemplars, an inverted index, TF-IDF containment over passage windows.

A text is cut into windows (lines, and their sentences); what stands between the marks of a slot is a window within its
window. Each window is looked up in an inverted index of exemplars (``exemplars``), and every exemplar of which it
holds a share of the weight (``COVERED``) is a match. A window is residue of a label where the matches with that
label together contain enough of the window's TF-IDF weight (``CONTAINED``). Tokens are beginnings of words, so that
forms of a word agree, numbers as one token, and pairs of characters of scripts without blanks; a slot's marks are a
token too. Weights come from document frequencies over the whole corpus.

Labels: ``message`` (error, block and scripts-required messages), ``filler``, ``slot``, ``chrome`` (navigation), and
``mention`` (prose that speaks of slots or filler: content). Without a match a window is content.

A document is excluded that has a slot or filler, or whose messages are as long as what is neither navigation nor
the headline. Null, empty and blank texts are never excluded. Texts are read whole.
"""

from __future__ import annotations

import html
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callweave.llm import exemplars as E

#: Characters of a word that count; of filler fewer, since its words are bent.
STEM, FILLER_STEM = 5, 4
#: Share of a window that matches must hold, share of an exemplar that makes a match, the same for mentions.
CONTAINED, COVERED, MENTIONED = 0.55, 0.2, 0.8
#: The share of documents that a token without exemplar is taken to be in, and the least share of any token: weights
#: follow shares of documents and not their number, so that they are alike at every size of the corpus.
OTHER, LEAST = 0.02, 0.0005

_TOKEN = re.compile(r"[^\W\d_]+|\d+")
_CJK = re.compile(r"[぀-ヿ㐀-鿿]")
_LINES = re.compile(r"[\n\r\x0b\x0c\x85  ]+")
_SENTENCES = re.compile(r"(?<=[.!?…])\s+|(?<=。)")
#: Marks before and behind the inside of a slot, whatever they mean; only exemplars say which of them make a slot.
_SPAN = re.compile(
    r"((?<!\\)[{\[<]+[%#=+]*|&(?:laquo|lt);|(?<![A-Za-z0-9_\\])(?:[$#]\{|\*\||[%$#@|~(_]+))\s*([^\W\d_][\w.\-]*(?:[ '’,:/][\w.\-'’]+)*?)\s*([%#]?[\]}>]+|&(?:raquo|gt);|(?:\|\*|[%$#@|~)_]+)(?![A-Za-z0-9_]))"
)
_MAY_SPAN = re.compile(r"[{\[<%$#@|~(]|__|&l|_HERE|[XxDdTtJjMm]{2}[ ./-]")
_BLANKS = re.compile(
    r"_{5,}|\b(?:XX|xx)([./-])(?:XX|xx)\1(?:20)?(?:XX|xx){1,2}\b|\b[A-Z]+(?:_[A-Z]+)*_HERE\b|\b(?:DD|dd|TT|tt|JJ|jj)(?:[./-]| )(?:MM|mm|Month|month)(?:[./-]| )(?:YYYY|yyyy|JJJJ|jjjj|AAAA|aaaa)\b|\b(?:YYYY|yyyy)-(?:MM|mm)-(?:DD|dd)\b"
)
LABELS = ("message", "filler", "chrome", "mention")
#: Names of tags, which are no slots.
TAGS = frozenset("a abbr b big blockquote body br center code dd div dl dt em font form h head hr html i img input label li link meta nav ol option p pre s script section select small span strong style sub sup table tbody td th thead title tr tt u ul".split())
#: Shapes whose inside must be known too.
WEAK = frozenset(("[w]", "(w)"))
#: What stands before a printed value, and behind it if anything does.
_UNSET = re.compile(rf"(?:^|[:,(]\s*|\b(?:{'|'.join(E.BEFORE_VALUES)})\s+)(?:{'|'.join(map(re.escape, E.UNSET))})(?=\s*(?:$|[.,;:!?)]|(?:{'|'.join(E.BEHIND_VALUES)})\b))", re.M)
_MAY_UNSET = re.compile("|".join(map(re.escape, E.UNSET)))



class _Stems(dict):
    """The token of a word without characters of scripts without blanks; a worker's memory."""

    def __missing__(self, t: str) -> str:
        if len(self) > 500_000:
            self.clear()
        out = self[t] = "0" if t[0].isdigit() else t[:STEM]
        return out


_stems = _Stems()


def window_tokens(window: str) -> list[str]:
    """Beginnings of words in lower case, numbers as one token, character pairs of scripts without blanks."""
    words = _TOKEN.findall(window.lower())
    if window.isascii() or not _CJK.search(window):
        return list(map(_stems.__getitem__, words))
    out: list[str] = []
    for t in words:
        if _CJK.search(t):
            out += [t[i : i + 2] for i in range(max(1, len(t) - 1))]
        else:
            out.append(_stems[t])
    return out


def windows(text: str) -> list[str]:
    """The passage windows of a text: the sentences of its lines."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text.replace("…", "… "))
    return [w for line in _LINES.split(text) if not line.isspace() for w in _SENTENCES.split(line) if w and not w.isspace()]


def spans(window: str) -> list[tuple[str, list[str], str]]:
    """(shape, tokens inside, inside) for what stands between marks; a shape is the marks with ``w`` for one word, ``w w`` for more."""
    out = []
    for m in _SPAN.finditer(window):
        inside = m.group(2)
        shape = f"{m.group(1)}w{m.group(3)}"
        out.append((shape, window_tokens(inside), inside))
    if (m := _BLANKS.search(window)) is not None:
        out.append(("blank", [], m.group()))
    return out


class _Memory(dict):
    """What a function of a token gives; a worker's memory."""

    def __init__(self, of: Callable[[str], float]):
        self.of = of

    def __missing__(self, t: str) -> float:
        if len(self) > 500_000:
            self.clear()
        out = self[t] = self.of(t)
        return out


class Index:
    """An inverted index of labelled exemplars: for each token its postings, a row of ones at the exemplars that have it."""

    def __init__(self, df: dict[str, int], n: int):
        entries = exemplar_sets()
        vocabulary = sorted(frozenset(t for _, own in entries for t in own) | slot_tokens())
        self.place = {t: i for i, t in enumerate(vocabulary)}
        self.weight = {t: math.log(1 + 1 / (df.get(t, 0) / max(n, 1) + LEAST)) for t in vocabulary}
        self.other = math.log(1 + 1 / (OTHER + LEAST))
        self.weights = np.array([self.weight[t] for t in vocabulary], np.float32)
        self.postings = np.zeros((len(vocabulary), len(entries)), np.float32)
        for i, (_, own) in enumerate(entries):
            self.postings[[self.place[t] for t in own], i] = 1
        labels = np.array([label for label, _ in entries])
        self.labels = {label: labels == label for label in LABELS}
        self.fill = {t: self.weight[t] for label, own in entries if label == "filler" for t in own}
        #: What a window must hold of each exemplar.
        self.needed = self.weights @ self.postings * np.where(labels == "mention", MENTIONED, COVERED).astype(np.float32) - np.float32(1e-4)
        self.slots: dict[str, set[str]] = {"blank": set()}
        for text in E.SLOTS:
            for shape, inside, _ in spans(text):
                self.slots.setdefault(shape, set()).update(inside)
        lorem = frozenset(w[:FILLER_STEM] for w in _TOKEN.findall(E.LOREM.lower()) if len(w) >= FILLER_STEM)
        self.bent = _Memory(lambda t: int(t[:FILLER_STEM] in lorem))
        self.known, self.all = _Memory(lambda t: self.weight.get(t, 0.0)), _Memory(lambda t: self.weight.get(t, self.other))

    def _slot(self, window: str) -> bool:
        for shape, inside, written in spans(window):
            known = self.slots.get(shape)
            if known is None:
                continue
            if shape in ("<w>", "&lt;w&gt;") and re.split(r"[\s/]", written, maxsplit=1)[0].lower() in TAGS:
                continue
            if shape not in WEAK:
                if len(written) > 2 or shape[0] in "{<[":
                    return True
                continue
            total = sum(map(self.all.__getitem__, inside))
            if inside and sum(self.weight.get(t, self.other) for t in inside if t in known) >= CONTAINED * total:
                return True
        return False

    def matches(self, held: Iterable[str]) -> dict[str, float]:
        """By label, the weight of a window's tokens that its matches hold."""
        places = [i for t in held if (i := self.place.get(t)) is not None]
        rows, weights = self.postings[places], self.weights[places]
        hit = weights @ rows >= self.needed
        return {label: float(weights[rows[:, own].any(axis=1)].sum()) for label, of in self.labels.items() if (own := hit & of).any()}

    def glance(self, window: str) -> tuple[str, int, list[str]]:
        """(label, words, tokens to look up) of a window; label '' where the postings have to be asked."""
        words = window_tokens(window)
        held = set(words)
        slot = _MAY_SPAN.search(window) is not None and self._slot(window) or self._unset(window)
        bent = sum(map(self.bent.__getitem__, held))
        filler = bent >= 3 and bent >= 0.5 * len(held)
        if slot or filler:
            return ("mention" if "mention" in self.matches(sorted(held)) else "slot" if slot else "filler"), len(words), []
        if sum(map(self.known.__getitem__, held)) < CONTAINED * sum(map(self.all.__getitem__, held)):
            return "content", len(words), []  # all exemplars together hold too little
        return "", len(words), sorted(held)

    def may_fill(self, held: list[str]) -> bool:
        """False where no exemplar of filler can contain enough of a window."""
        inside = sum(self.fill[t] for t in held if t in self.fill)
        return inside > 0 and inside >= CONTAINED * sum(map(self.all.__getitem__, held))

    def judge(self, held: list[str]) -> str:
        """The label of a window without slot, by its tokens."""
        total = sum(map(self.all.__getitem__, held))
        best, score = "content", 0.0
        for label, inside in self.matches(held).items():
            if label != "mention" and inside >= CONTAINED * total and inside > score:
                best, score = label, inside
        return best

    def label(self, window: str) -> tuple[str, int]:
        """(label, words) of a window."""
        label, n, held = self.glance(window)
        return label or self.judge(held), n

    @staticmethod
    def _unset(window: str) -> bool:
        """A value that was printed for want of another, where a value stands."""
        return _MAY_UNSET.search(window) is not None and _UNSET.search(window) is not None


def exemplar_sets() -> list[tuple[str, frozenset[str]]]:
    """(label, tokens) of every exemplar; those of several sentences are one for each sentence."""
    out: dict[tuple[str, frozenset[str]], None] = {}
    for label, texts in (("message", (*E.STATUS_LINES, *E.MESSAGES)), ("filler", E.FILLERS), ("chrome", E.CHROME)):
        for text in texts:
            for part in windows(text):
                out[label, frozenset(window_tokens(part))] = None
    for text in E.MENTIONS:
        out["mention", frozenset(window_tokens(text))] = None
    return [(label, own) for label, own in out if own]


def is_residue(text: str | None, index: Index) -> bool:
    """True where slots or filler stand for content, or messages are as long as the content."""
    if not text or not text.strip():
        return False
    told = {"content": 0, "message": 0, "chrome": 0, "filler": 0}
    open_: list[tuple[int, list[str]]] = []
    head = True
    for window in windows(text):
        label, n, held = index.glance(window)
        if label in ("slot", "filler"):
            return True
        if not label and head:
            label = index.judge(held)
        if label == "filler":
            return True
        if not label:
            open_.append((n, held))
            continue
        if label == "content" and head and not window.rstrip().endswith((".", "!", "。")):
            head = False  # the headline
            continue
        if label != "chrome":
            head = False
        told["content" if label == "mention" else label] += n
    # Long windows first: what is left cannot change the answer once content outweighs it, unless it is filler.
    rest = sum(n for n, _ in open_)
    for n, held in sorted(open_, reverse=True):
        if told["content"] > told["message"] + rest and not index.may_fill(held):
            rest -= n
            continue
        label = index.judge(held)
        if label == "filler":
            return True
        told[label] += n
        rest -= n
    return told["message"] > 0 and told["message"] >= told["content"]


def slot_tokens() -> frozenset[str]:
    return frozenset(t for text in E.SLOTS for _, inside, _ in spans(text) for t in inside)


def exemplar_tokens() -> frozenset[str]:
    return frozenset(t for _, own in exemplar_sets() for t in own) | slot_tokens()


def document_frequencies(df: DataFrame, text: str) -> tuple[dict[str, int], int]:
    """How many documents have each token of the exemplars, and how many documents have text: over the whole corpus."""
    wanted = exemplar_tokens() - {"0"}  # numbers count as common

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = Counter(), 0
        for batch in batches:
            for value in batch.column(0).to_pylist():
                if value:
                    n += 1
                    counts.update(wanted.intersection(window_tokens(value)))
        yield pa.RecordBatch.from_arrays([pa.array([*counts, ""]), pa.array([*counts.values(), n], pa.int64())], ["token", "n"])

    rows = df.select(text).where(F.col(text).isNotNull()).mapInArrow(run, "token string, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()  # a row a token of the exemplars
    counts = {r["token"]: r["n"] for r in rows}
    n = counts.pop("", 0)
    return counts | {"0": n}, n


def mark_residue(df: DataFrame, id_column: str, text: str) -> DataFrame:
    """``id_column`` and ``is_residue``, one row for each row. Two passes over the texts, no shuffle of texts."""
    frequencies, n = document_frequencies(df, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(frequencies, n)
        for batch in batches:
            marks = np.fromiter((is_residue(v, index) for v in batch.column(1).to_pylist()), bool, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks)], [id_column, "is_residue"])

    kind = df.schema[id_column].dataType.simpleString()
    return df.select(id_column, text).mapInArrow(run, f"`{id_column}` {kind}, is_residue boolean")


def without_residue(df: DataFrame, text: str) -> DataFrame:
    """The rows of ``df`` that are not residue, with all their columns. No join: rows are filtered where they are."""
    frequencies, n = document_frequencies(df, text)
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(frequencies, n)
        for batch in batches:
            keep = np.fromiter((not is_residue(v, index) for v in batch.column(at).to_pylist()), bool, batch.num_rows)
            yield batch.filter(pa.array(keep))

    return df.mapInArrow(run, df.schema)
