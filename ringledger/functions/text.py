"""Text that compares without regard to case, as the reports' sources do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Spark's collation that ignores case. ``UTF8_LCASE_RTRIM`` also ignores final spaces.
ANY_CASE = "UTF8_LCASE"
#: The collation of plain text.
BYTES = "UTF8_BINARY"


def collated(df: DataFrame, collation: str = ANY_CASE, columns: list[str] | None = None) -> DataFrame:
    """``df`` with its text columns, or those named, under a collation.

    Filters, ``IN`` lists, joins, groups and distinct then compare by that collation, all
    inside Spark; a join still hashes and shuffles once, on the collation's key. A group
    shows one of the spellings that it holds. Only top-level text is changed.
    """
    wanted = df.columns if columns is None else columns
    return df.select(
        *(F.collate(df[f"`{c}`"], collation).alias(c) if c in wanted and _is_text(kind) else df[f"`{c}`"]
          for c, kind in df.dtypes)
    )


def as_key(df: DataFrame, column: str) -> Column:
    """A text column of ``df`` as a key that equal spellings share, compared byte by byte.

    Without a collation that is the column itself. Under one that ignores case it is in
    lower case, and without final spaces where these are ignored too. Unlike a collated
    column it keeps its partitioning from an aggregate to the joins that follow.
    """
    kind = dict(df.dtypes)[column]
    if " collate " not in kind:
        return df[f"`{column}`"]
    key = F.collate(df[f"`{column}`"], BYTES)
    if "LCASE" in kind or "_CI" in kind:
        key = F.lower(key)
    return F.rtrim(key) if "RTRIM" in kind else key


def plain(df: DataFrame) -> DataFrame:
    """``df`` with all text compared byte by byte again."""
    return collated(df, BYTES)


def alike(frames: list[DataFrame]) -> list[DataFrame]:
    """Frames of the same columns whose text columns share a collation, as a union needs.

    A column that has a collation in one frame gets it in all.
    """
    kinds: dict[str, str] = {}
    for df in frames:
        kinds |= {c: kind for c, kind in df.dtypes if " collate " in kind}
    by_collation: dict[str, list[str]] = {}
    for column, kind in kinds.items():
        by_collation.setdefault(kind.split(" collate ")[1], []).append(column)
    for collation, columns in by_collation.items():
        frames = [collated(df, collation, columns) for df in frames]
    return frames


def _is_text(kind: str) -> bool:
    return kind == "string" or kind.startswith("string collate ")
