"""Help for plans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(expression: Column) -> Column:
    """``expression``, kept from being spelled out again in every filter and projection above it.

    The guard is always true; being no pure function of the row it holds the projection in place.
    """
    return F.when(F.monotonically_increasing_id() >= 0, expression)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once, for bodies inside higher-order functions that use it several times."""
    return F.transform(F.array(value), body)[0]
