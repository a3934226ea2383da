"""Which documents are held out from learning: by a checksum of the id."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def in_fold(doc_id: Column, folds: int, fold: int) -> Column:
    """True where crc32 of the id as text leaves ``fold``; a null id is never held out."""
    remainder = F.crc32(F.encode(doc_id.cast("string"), "utf-8")) % folds
    return F.coalesce(remainder == fold, F.lit(False))
