"""Scans and sinks: JSON lines, JSON and YAML documents, saved pages, call documents, and commits of several artifacts."""

from __future__ import annotations

import uuid
import zipfile
from collections.abc import Iterator
from io import BytesIO
from pathlib import Path
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.operators.health import assert_valid

MOST_BYTES, SNAPSHOT_BYTES = 10 * 1024 * 1024, 15 * 1024 * 1024


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A table of JSON lines; a missing path is an empty table, blank lines are skipped."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_jsonl(df: DataFrame, path: str, key: str = "id") -> None:
    """JSON lines sorted by key, nulls written, in one step: into a folder beside the target that then takes its place.

    Rows are range-partitioned and sorted, so part files are in order and no task holds all rows.
    """
    staged = stage(df.orderBy(key).select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")), path)
    replace(df.sparkSession, staged, path)


def write_jsonl_plainly(df: DataFrame, path: str) -> None:
    """JSON lines in the order of ``df``, written straight to ``path`` and over what is there: a reader may meet it half done."""
    df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)


def stage(lines: DataFrame, path: str) -> str:
    """``lines`` (one text column) written beside ``path``; returns where."""
    staged = f"{path}.{uuid.uuid4().hex}.tmp"
    lines.write.text(staged)
    return staged


def replace(spark: SparkSession, staged: str, path: str) -> None:
    jvm = spark.sparkContext._jvm
    source, target = jvm.org.apache.hadoop.fs.Path(staged), jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.old")
    had = fs.exists(target)
    if had and not fs.rename(target, old):
        raise OSError(f"cannot move {path} away")
    if not fs.rename(source, target):
        if had:
            fs.rename(old, target)
        raise OSError(f"cannot put {path} in place")
    if had:
        fs.delete(old, True)


def commit(truth: DataFrame, path: str, derived: dict[str, DataFrame], key: str = "id") -> None:
    """All rows of ``truth`` validated, it and the derived texts staged, then put in place, the truth first.

    Nothing is replaced unless everything could be staged; what was staged is removed on failure.
    """
    spark = truth.sparkSession
    staged: list[tuple[str, str]] = []
    try:
        rows = assert_valid(truth).orderBy(key)
        staged.append((stage(rows.select(F.to_json(F.struct(*truth.columns), {"ignoreNullFields": "false"}).alias("value")), path), path))
        for target, lines in derived.items():
            staged.append((stage(lines, target), target))
        while staged:
            replace(spark, *staged[0])
            staged.pop(0)
    finally:
        for left, _ in staged:
            target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(left)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def read_document(spark: SparkSession, path: str) -> DataFrame:
    """A JSON document as one row; an unreadable or missing one is an empty table of no columns but ``_corrupt_record``."""
    if not _exists(spark, path):
        return spark.createDataFrame([], "_corrupt_record string")
    return spark.read.option("multiLine", True).option("mode", "PERMISSIVE").json(path)


def read_yaml_table(spark: SparkSession, path: str, root: str, schema: str) -> DataFrame:
    """A list of a YAML file as a table; keys that the schema has and an item lacks are null. Configuration is small."""
    import yaml

    data = yaml.safe_load(Path(path).read_text(encoding="utf-8")) if Path(path).exists() else None
    items = (data or {}).get(root) or []
    kind = spark.createDataFrame([], schema).schema
    return spark.createDataFrame([tuple(item.get(f.name) for f in kind.fields) for item in items], kind)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Saved pages (path, html), one row a file."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("html"))


def read_saved(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Saved listings (source_key, path, html) by the key of their source, each a file or a folder of files."""
    out = spark.createDataFrame([], "source_key string, path string, html string")
    for key, path in sorted(paths.items()):
        out = out.unionByName(read_pages(spark, path).select(F.lit(key).alias("source_key"), "path", "html"))
    return out


def snapshot_fits(content: Column) -> Column:
    return F.octet_length(content) <= SNAPSHOT_BYTES


_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def docx_text(content: bytes) -> str | None:
    """The text of a word-processing document, blanks collapsed; null for what is none or too large."""
    if not content or len(content) > MOST_BYTES:
        return None
    try:
        with zipfile.ZipFile(BytesIO(content)) as z:
            info = z.getinfo("word/document.xml")
            if info.file_size > 8 * MOST_BYTES:
                return None
            root = ElementTree.fromstring(z.read(info))
    except (zipfile.BadZipFile, KeyError, ElementTree.ParseError):
        return None
    return " ".join(" ".join("".join(t.text or "" for t in p.iter(f"{_W}t")) for p in root.iter(f"{_W}p")).split())


def pdf_text(content: bytes, pages: int = 20) -> str | None:
    """The text of a PDF where the reader is installed; null for what is broken, too large, or of more than ``pages`` pages."""
    try:
        from pypdf import PdfReader
    except ImportError:
        return None
    if not content or len(content) > MOST_BYTES:
        return None
    try:
        found = PdfReader(BytesIO(content)).pages
        return None if len(found) > pages else " ".join(" ".join(page.extract_text() or "" for page in found).split())
    except Exception:  # noqa: BLE001 - any broken file
        return None


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of call documents, .docx and .pdf."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = [docx_text(bytes(c)) if p.lower().endswith(".docx") else pdf_text(bytes(c)) for p, c in zip(pdf["path"], pdf["content"], strict=True)]
            yield pd.DataFrame({"path": pdf["path"], "text": texts})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, text string")
