"""Named queries of the problems in this subpackage, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callweave.llm.canon import map_values
from callweave.llm.cut import cut_rates, find_cut
from callweave.llm.looks import look_classes, one_form, same_look_pairs
from callweave.llm.mix import mixture
from callweave.llm.residue import mark_residue, without_residue
from callweave.llm.terms import term_frequencies
from callweave.llm.tokens import count_tokens, encode_column
from callweave.operators.packed import Splitter, shared_codes
from callweave.session import settle
from callweave.tables import load


def _cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_cut(load(spark, sf_dir, "raw_records"), "record_id", "source_key", "summary", "title")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose summary lost its end."""
    return _cut(spark, sf_dir).where("is_cut").select("record_id")


def p1_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of each source's non-empty summaries are cut."""
    return cut_rates(_cut(spark, sf_dir)).withColumnRenamed("source", "source_key")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of rows whose titles or summaries look the same and are not the same string."""
    pairs = same_look_pairs(load(spark, sf_dir, "raw_records"), "record_id", ["title", "summary"])
    return pairs.select("field_name", F.col("id_a").alias("record_id_a"), F.col("id_b").alias("record_id_b"))


def p2_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of each title and summary and its number of links."""
    found = look_classes(load(spark, sf_dir, "raw_records"), "record_id", ["title", "summary"])
    return found.withColumnRenamed("id", "record_id")


def p2_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles and summaries in one form."""
    return one_form(load(spark, sf_dir, "raw_records"), "record_id", ["title", "summary"])


def p4_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every keyword in lower case with its occurrences, its records and its mark."""
    records = load(spark, sf_dir, "raw_records")
    codes = shared_codes(records, "publisher_keywords")

    def reader():
        split = Splitter(codes.value)
        return lambda entries: [k.lower() for k in split(entries)]

    return term_frequencies(records, "publisher_keywords", reader)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms too rare or too common to be a topic."""
    return p4_terms(spark, sf_dir).where("mark is not null").select("term", "mark")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The watched journal that each freely typed journal means, -1 for none."""
    reference = load(spark, sf_dir, "watched_journals").select(F.col("journal_id").alias("id"), "name", "publisher", "aliases")
    found = map_values(load(spark, sf_dir, "raw_records"), "record_id", "journal", "journals", reference)
    return found.withColumnRenamed("id", "journal_id")


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token ids of each document."""
    return encode_column(load(spark, sf_dir, "documents"), "doc_id", "text")


def _mixture(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    sized = settle(count_tokens(load(spark, sf_dir, "documents"), ["doc_id", "source"], "text"))
    return mixture(sized, load(spark, sf_dir, "mix_targets"))


def p8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document of the mixture with its rate and its copies."""
    return _mixture(spark, sf_dir)[0]


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each targeted source its target share and the share that it really got."""
    return _mixture(spark, sf_dir)[1]


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that are template residue, filler, error pages or demands for scripts."""
    return mark_residue(load(spark, sf_dir, "documents"), "doc_id", "text").where("is_residue").select("doc_id")


def p9_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents without residue."""
    return without_residue(load(spark, sf_dir, "documents"), "text")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p1_rates": p1_rates,
    "p2_found": p2_found,
    "p2_classes": p2_classes,
    "p2_forms": p2_forms,
    "p4_found": p4_found,
    "p4_terms": p4_terms,
    "p6_found": p6_found,
    "p7_ids": p7_ids,
    "p8_mixture": p8_mixture,
    "p8_shares": p8_shares,
    "p9_found": p9_found,
    "p9_corpus": p9_corpus,
}

# The twins of problem 2 map code point by code point, by arithmetic on Unicode's blocks, and share no code with the operator.
# Half-width kana in the order of their block, letters of other scripts and the Latin letters they look like.
_KANA = "。「」、・ヲァィゥェォャュョッーアイウエオカキクケコサシスセソタチツテトナニヌネノハヒフヘホマミムメモヤユヨラリルレロワン\u3099\u309a"
_ALIKE = ("АВЕЅІЇЈКМНОРСТУХԀԚԜҮЁҺаеѕіїјорсухԁԛԝүёһӏӀΑΒΕΖΗΙΚΜΝΟΡΤΥΧͿνοϲϳօոսհցɡɑı", "ABESIÏJKMHOPCTYXDQWYËhaesiïjopcyxdqwyëhlIABEZHIKMNOPTYXJvocjonuhggai")
_ROMAN = ("I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX", "X", "XI", "XII", "L", "C", "D", "M")


def _form_sql(x: str) -> str:
    """What ``x`` looks like: one CASE for each code point."""
    listed = lambda items: "[" + ", ".join(f"'{i}'" for i in items) + "]"
    unseen = ("BETWEEN 8203 AND 8207", "BETWEEN 8234 AND 8238", "BETWEEN 8288 AND 8303", "BETWEEN 6155 AND 6158", "BETWEEN 65024 AND 65039", "BETWEEN 65529 AND 65531", "BETWEEN 917505 AND 917631", "BETWEEN 917760 AND 917999", "IN (173, 847, 1564, 4447, 4448, 6068, 6069, 12644, 65279, 65440)")
    blank = "k BETWEEN 9 AND 13 OR k BETWEEN 8192 AND 8202 OR k IN (133, 160, 5760, 8232, 8233, 8239, 8287, 12288)"
    cases = [
        ("k BETWEEN 32 AND 126", "chr(k)"), (" OR ".join(f"k {r}" for r in unseen), "''"), (blank, "' '"), ("k IN (8208, 8209)", "'-'"), ("k = 8230", "'...'"), ("k BETWEEN 65281 AND 65374", "chr(k - 65248)"),
        ("k BETWEEN 65377 AND 65439", f"substr('{_KANA}', k - 65376, 1)"), ("k BETWEEN 64256 AND 64262", f"{listed(('ff', 'fi', 'fl', 'ffi', 'ffl', 'st', 'st'))}[k - 64255]"),
        ("k BETWEEN 8544 AND 8559", f"{listed(_ROMAN)}[k - 8543]"), ("k BETWEEN 8560 AND 8575", f"lower({listed(_ROMAN)}[k - 8559])"),
        ("k BETWEEN 119808 AND 120483", "chr(CAST(CASE WHEN (k - 119808) % 52 < 26 THEN 65 + (k - 119808) % 52 ELSE 71 + (k - 119808) % 52 END AS INTEGER))"), ("k BETWEEN 120782 AND 120831", "chr(CAST(48 + (k - 120782) % 10 AS INTEGER))"),
        (f"strpos('{_ALIKE[0]}', chr(k)) > 0", f"substr('{_ALIKE[1]}', strpos('{_ALIKE[0]}', chr(k)), 1)"),
    ]
    each = f"list_transform(list_transform(regexp_extract_all({x}, '(?s).'), lambda c: unicode(c)), lambda k: CASE {' '.join(f'WHEN {when} THEN {then}' for when, then in cases)} ELSE chr(k) END)"
    return f"nullif(trim(nfc_normalize(array_to_string({each}, ''))), '')"


_LONG = f"SELECT 'title' AS field_name, record_id, title AS raw, {_form_sql('title')} AS form FROM raw_records UNION ALL SELECT 'summary', record_id, summary, {_form_sql('summary')} FROM raw_records"
ORACLE: dict[str, str] = {
    "p2_found": f"WITH f AS ({_LONG}) SELECT a.field_name, a.record_id AS record_id_a, b.record_id AS record_id_b FROM f a JOIN f b ON a.field_name = b.field_name AND a.form = b.form AND a.record_id < b.record_id AND a.raw <> b.raw",
    "p2_classes": f"WITH f AS (SELECT * FROM ({_LONG}) WHERE form IS NOT NULL), n AS (SELECT *, count(*) OVER (PARTITION BY field_name, form) - count(*) OVER (PARTITION BY field_name, form, raw) AS links FROM f) SELECT field_name, record_id, md5(form) AS class, links FROM n",
    "p2_forms": f"SELECT record_id, {_form_sql('title')} AS title, {_form_sql('summary')} AS summary FROM raw_records",
}
