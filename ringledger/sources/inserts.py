"""Rows put into declared tables by position."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
_TIMES = ("date", "timestamp", "timestamp_ntz")


def by_position(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``df`` as a declared table takes it: column by column in order, whatever their names.

    A value is converted to the declared type as the SQL standard's store assignment does:
    numbers to numbers, days and times to each other, anything to text. A number out of the
    type's range, or a text longer than a declared ``varchar(n)``, fails the query; only
    decimal places beyond the declared ones are rounded. Other conversions, such as text to
    number, and a wrong count of columns are refused at once.
    """
    if len(df.columns) != len(columns):
        raise ValueError(f"{len(df.columns)} columns for a table of {len(columns)}")
    # Columns are taken by place, as two of them may have one name.
    numbered = df.toDF(*(f"c{i}" for i in range(len(columns))))
    return numbered.select(
        *(_stored(numbered[f"c{i}"], have, name, wanted).alias(name)
          for i, ((_, have), (name, wanted)) in enumerate(zip(df.dtypes, columns.items())))
    )


def insert(df: DataFrame, path: str, columns: dict[str, str]) -> None:
    """Append ``by_position`` of ``df`` to the parquet table at ``path``."""
    by_position(df, columns).write.mode("append").parquet(path)


def _stored(value: Column, have: str, name: str, wanted: str) -> Column:
    plain = have.split(" collate ")[0]
    text = re.fullmatch(r"(?:var)?char\((\d+)\)", wanted)
    if text:
        fits = F.char_length(F.rtrim(value.cast("string"))) <= int(text[1])
        return _or_fail(value.cast("string"), value, fits, name, wanted)
    if wanted == plain or plain == "void" or wanted == "string":
        return value if wanted == plain else value.cast(wanted)
    if plain.startswith(_NUMBERS) and wanted.startswith(_NUMBERS):
        return _or_fail(value.try_cast(wanted), value, value.try_cast(wanted).isNotNull(), name, wanted)
    if plain in _TIMES and wanted in _TIMES:
        return value.cast(wanted)
    raise TypeError(f"{name}: {have} can't be stored as {wanted}")


def _or_fail(stored: Column, value: Column, fits: Column, name: str, wanted: str) -> Column:
    wrong = F.concat(F.lit(f"{name} does not fit {wanted}: "), value.cast("string"))
    failed = F.raise_error(wrong).cast("string" if "char" in wanted else wanted)
    return F.when(value.isNull() | fits, stored).otherwise(failed)
