"""One form for texts that look the same: embedded SQL over Arrow partitions.

The form of a text: invisible characters removed; full-width, half-width and other compatibility forms, every kind
of blank, the hyphens that look like ``-`` and look-alike letters mapped by ``translate``; ligatures and Roman
numerals spelled out; accents composed by ``nfc_normalize``; outer blanks removed. Case, accents, digits,
punctuation and words stay as they are. The mapping tables are built from Unicode's own data by rule, but for the
list of look-alike letters.

The SQL runs in a DuckDB connection of one thread inside each Arrow partition; what leaves the partition for a
comparison is a pair of 128-bit hashes, never the text.

Null, empty and blank texts have the form null and are equal to nothing.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callweave.session import settle

# Letters of other scripts that look like Latin ones.
LOOK_ALIKES = {
    # Cyrillic, capital
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ї": "Ï", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O",
    "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "Ԁ": "D", "Ԛ": "Q", "Ԝ": "W", "Ү": "Y", "Ё": "Ë", "Һ": "h",
    # Cyrillic, small
    "а": "a", "е": "e", "ѕ": "s", "і": "i", "ї": "ï", "ј": "j", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x",
    "ԁ": "d", "ԛ": "q", "ԝ": "w", "ү": "y", "ё": "ë", "һ": "h", "ӏ": "l", "Ӏ": "I",
    # Greek, capital
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P",
    "Τ": "T", "Υ": "Y", "Χ": "X", "Ϳ": "J",
    # Greek, small
    "ν": "v", "ο": "o", "ϲ": "c", "ϳ": "j",
    # Armenian and others
    "օ": "o", "ո": "n", "ս": "u", "հ": "h", "ց": "g", "ɡ": "g", "ɑ": "a", "ı": "i",
}
#: What cannot be seen: soft hyphen, joiners, marks of direction, variation selectors, tags, byte-order mark.
INVISIBLE = "\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180e\u200b-\u200f\u202a-\u202e\u2060-\u206f\u3164\ufe00-\ufe0f\ufeff\uffa0\ufff9-\ufffb\U000e0001-\U000e007f\U000e0100-\U000e01ef"
_BLANKS = "\t\n\x0b\x0c\r\x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_HYPHENS = "‐‑"
_IT = "\0it\0"
_KINDS = ("<wide>", "<narrow>", "<font>", "<compat>")


_BLOCKS = {  # what is mapped by one table each
    "marks": ((0x2010, 0x2070), (0x2100, 0x2190), (0xFB00, 0xFB07)),
    "wide": ((0x3000, 0x3100), (0xFE10, 0xFE70), (0xFF00, 0xFFF0)),
    "font": ((0x1D400, 0x1D800),),
}


def tables() -> tuple[dict[str, dict[str, str]], dict[str, str]]:
    """The one-to-one mappings by block, and the characters that stand for several."""
    single: dict[str, dict[str, str]] = {}
    longer: dict[str, str] = {}
    for name, blocks in _BLOCKS.items():
        own = single[name] = {}
        for ch in (chr(i) for block in blocks for i in range(*block)):
            kind = unicodedata.decomposition(ch).split(" ")[0]
            plain = unicodedata.normalize("NFKC", ch)
            if kind not in _KINDS and not 0xFE10 <= ord(ch) < 0xFE70 or plain == ch or plain.startswith(" ") or ch in _HYPHENS:
                continue
            if len(plain) == 1:
                own[ch] = plain
            else:
                longer[ch] = plain
    single["marks"] |= dict.fromkeys(_HYPHENS, "-")
    single["wide"] |= {"\uff9e": "\u3099", "\uff9f": "\u309a"}  # the half-width voicing marks, which combine
    single["looks"] = LOOK_ALIKES
    return single, longer


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _class(characters: str) -> str:
    """A character class of exactly these characters."""
    return _quote("[" + "".join("\\" + c if c in "\\]^-[" else c for c in characters) + "]")


def _layers() -> list[tuple[str, str]]:
    """(class of characters that need it, expression over _IT), in order."""
    single, longer = tables()
    spelled = _IT
    for ch, plain in longer.items():
        spelled = f"replace({spelled}, {_quote(ch)}, {_quote(plain)})"
    shift = {name: f"translate({_IT}, {_quote(''.join(own))}, {_quote(''.join(own.values()))})" for name, own in single.items()}
    unseen, blank = _quote(f"[{INVISIBLE}]"), _class(_BLANKS)
    return [
        (unseen, f"regexp_replace({_IT}, {unseen}, '', 'g')"),
        (blank, f"regexp_replace({_IT}, {blank}, ' ', 'g')"),
        *((_class("".join(single[n])), shift[n]) for n in ("wide", "font", "marks")),
        (_class("".join(longer)), spelled),
        (_class("".join(single["looks"])), shift["looks"]),
        (_quote(r"[^\x00-\x7F]"), f"nfc_normalize({_IT})"),
    ]


def forms_sql(source: str, fields: list[str], keep: list[str]) -> str:
    """A query of the columns ``keep`` and, as ``form_<field>``, the form of each field of the table ``source``.

    One nested query for each mapping; a text meets a mapping only if it holds a character that needs it.
    """
    kept = ", ".join(f'"{k}"' for k in keep)
    sql = f"SELECT {kept}, " + ", ".join(f'"{f}" AS "form_{f}"' for f in fields) + f" FROM {source}"
    for needs, change in _layers():
        one = lambda f: f'CASE WHEN regexp_matches("form_{f}", {needs}) THEN {change.replace(_IT, chr(34) + 'form_' + f + chr(34))} ELSE "form_{f}" END AS "form_{f}"'  # noqa: B023, E731
        sql = f"SELECT {kept}, " + ", ".join(map(one, fields)) + f" FROM ({sql})"
    return f"SELECT {kept}, " + ", ".join(f"nullif(trim(\"form_{f}\"), '') AS \"form_{f}\"" for f in fields) + f" FROM ({sql})"


def _connect():
    import duckdb

    con = duckdb.connect(config={"threads": 1, "memory_limit": "512MB"})
    con.execute("SET enable_progress_bar = false")
    return con


def _run_sql(sql: str):
    """``sql`` over each batch as the table ``batch``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        con = _connect()
        for whole in batches:
            some = max(1, min(2048, int(16e6 // (whole.nbytes / max(1, whole.num_rows) + 1))))  # texts may be long
            for begin in range(0, whole.num_rows, some):
                con.register("batch", pa.Table.from_batches([whole.slice(begin, some)]))
                yield from con.sql(sql).to_arrow_table().to_batches()
                con.unregister("batch")
        con.close()

    return run


def one_form(df: DataFrame, id_column: str, fields: list[str]) -> DataFrame:
    """``id_column`` and each of ``fields`` in its form. No shuffle."""
    kind = df.schema[id_column].dataType.simpleString()
    sql = f'SELECT "{id_column}", ' + ", ".join(f'"form_{f}" AS "{f}"' for f in fields) + f" FROM ({forms_sql('batch', fields, [id_column])})"
    return df.select(id_column, *fields).mapInArrow(_run_sql(sql), ", ".join([f"`{id_column}` {kind}", *(f"`{f}` string" for f in fields)]))


def look_hashes(df: DataFrame, id_column: str, fields: list[str]) -> DataFrame:
    """(field_name, id, form, raw): 128-bit hashes of the form and of the text of each non-blank value."""
    kind = df.schema[id_column].dataType.simpleString()
    one = lambda f: f"SELECT '{f}' AS field_name, \"{id_column}\" AS id, unhex(md5(\"form_{f}\")) AS form, unhex(md5(\"{f}\")) AS raw FROM forms WHERE \"form_{f}\" IS NOT NULL"
    sql = f"WITH forms AS MATERIALIZED ({forms_sql('batch', fields, [id_column, *fields])}) " + " UNION ALL ".join(map(one, fields))
    return df.select(id_column, *fields).mapInArrow(_run_sql(sql), f"field_name string, id {kind}, form binary, raw binary")


def look_classes(df: DataFrame, id_column: str, fields: list[str]) -> DataFrame:
    """(field_name, id, class, links): one row for each non-blank value, the class of all that look like it, and with how many
    rows that are not the same string it is linked. The pairs of ``same_look_pairs`` without spelling them out: two counts,
    combined before the shuffle, so that a hot text is no burden."""
    rows = settle(look_hashes(df, id_column, fields))
    same = rows.groupBy("field_name", "form", "raw").agg(F.count("*").alias("same"))
    alike = same.groupBy("field_name", "form").agg(F.sum("same").alias("alike"))
    counted = same.join(alike, ["field_name", "form"]).where("alike > same")
    linked = rows.join(counted, ["field_name", "form", "raw"], "left")
    return linked.select("field_name", "id", F.lower(F.hex("form")).alias("class"), F.coalesce(F.col("alike") - F.col("same"), F.lit(0)).alias("links"))


def same_look_pairs(df: DataFrame, id_column: str, fields: list[str]) -> DataFrame:
    """(field_name, id_a, id_b), a < b: rows whose values of a field differ as strings and have one form.

    Classes with a single spelling are dropped first; then spellings are paired, and only then rows, so rows that
    repeat one spelling never meet each other, however many they are.
    """
    # Hashes are made once: they are two small columns, and three joins read them.
    rows = settle(look_hashes(df, id_column, fields))
    spread = rows.groupBy("field_name", "form").agg(F.min("raw").alias("lo"), F.max("raw").alias("hi")).where("lo <> hi").select("field_name", "form")
    rows = rows.join(spread, ["field_name", "form"], "left_semi")
    spellings = rows.select("field_name", "form", "raw").distinct()
    pairs = (
        spellings.withColumnRenamed("raw", "raw_a").join(spellings.withColumnRenamed("raw", "raw_b"), ["field_name", "form"])
        .where("raw_a < raw_b").select("field_name", "form", "raw_a", "raw_b")
    )
    left = rows.select("field_name", "form", F.col("raw").alias("raw_a"), F.col("id").alias("one"))
    right = rows.select("field_name", "form", F.col("raw").alias("raw_b"), F.col("id").alias("two"))
    met = pairs.join(left, ["field_name", "form", "raw_a"]).join(right, ["field_name", "form", "raw_b"])
    return met.where("one <> two").select("field_name", F.least("one", "two").alias("id_a"), F.greatest("one", "two").alias("id_b"))
