"""Evaluate a column once and use it many times inside a lambda."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    A column named inside the lambda of ``transform`` or ``aggregate`` is evaluated
    again for every element: subtracting ``array_max(x)`` from each element of ``x``
    would be quadratic. Passing the value through a one-element array makes it a lambda
    variable, which is bound once.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
