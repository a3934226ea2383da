"""Columns that an operator passes through, in one struct, so that their names can't clash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Passed:
    """``columns`` of ``docs`` as one column: ``struct`` packs them, ``get`` and ``all`` unpack."""

    def __init__(self, docs: DataFrame, columns: list[str], name: str = "row") -> None:
        self.columns, self.name = columns, name
        fields = [docs[c].alias(f"f{i}") for i, c in enumerate(columns)]
        self.struct = F.struct(F.lit(0).alias("f"), *fields).alias(name)

    def get(self, column: str) -> Column:
        field = f"f{self.columns.index(column)}"
        return F.col(self.name).getField(field).alias(column)

    def all(self) -> list[Column]:
        return [self.get(column) for column in self.columns]
