"""Statistics of one row, fetched once and used as literals by the expressions that need them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Fixed:
    """The single row of an aggregate. ``getField(name)`` is its value as a literal column.

    A scalar subquery would stay lazy, but it is planned and run once per reference, and fences or
    scaled metrics refer to their statistics many times.
    """

    def __init__(self, table: DataFrame):
        self._row = table.first()
        self._types = {f.name: f.dataType for f in table.schema.fields}

    def getField(self, name: str) -> Column:
        return F.lit(self._row[name]).cast(self._types[name])

    def value(self, name: str):
        return self._row[name]
