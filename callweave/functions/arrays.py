"""Array and map functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from callweave.functions.text import collapse

def empty() -> Column:
    return F.array().cast("array<string>")


def ordered_set(*arrays: Column) -> Column:
    """The union of arrays of strings: blanks collapsed, empty and null items dropped, the first occurrence kept."""
    joined = F.concat(*[F.coalesce(a, empty()) for a in arrays])
    return F.array_distinct(F.filter(F.transform(joined, collapse), lambda x: x.isNotNull() & (x != "")))


def one(text: Column) -> Column:
    """An array of the text, empty for null."""
    return F.array_compact(F.array(text))


def is_subset(part: Column, whole: Column) -> Column:
    return F.size(F.array_except(part, whole)) == 0


def same_set(a: Column, b: Column) -> Column:
    return F.array_sort(F.array_distinct(a)) == F.array_sort(F.array_distinct(b))


def toggled(values: Column, item: Column) -> Column:
    """``values`` without ``item`` if it is there, with it at the end if not."""
    return F.when(F.array_contains(values, item), F.array_remove(values, item)).otherwise(F.array_append(values, item))


def merged_map(left: Column, right: Column) -> Column:
    """Both maps, the right one's values where both have a key."""
    return F.map_zip_with(left, right, lambda _, a, b: F.coalesce(b, a))


def first_scalar(json: Column, paths: list[str]) -> Column:
    """The first of several JSON paths that holds a non-empty scalar."""
    return F.coalesce(*[F.when(~F.get_json_object(json, p).rlike(r"^\s*[\[{]") & (F.get_json_object(json, p) != ""), F.get_json_object(json, p)) for p in paths])
