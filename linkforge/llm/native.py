"""Column helpers for operators without Python on the executors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate value once and use it many times: inside body it's a bound variable, which Catalyst can't inline."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Runs of anything but space and \\t..\\r."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")
