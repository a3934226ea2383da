"""Readers for source tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ringledger.functions.text import collated


def read_source(
    spark: SparkSession,
    location: str,
    columns: dict[str, str],
    zone: str | None = None,
    collation: str | None = None,
) -> DataFrame:
    """Read a source with exactly the named columns and types.

    ``location`` is a table name of up to three parts (``catalog.schema.table``),
    which may also be a view, or a parquet path (anything with a slash). ``zone`` is
    where the source's clock stands, if it has times with a zone. With a ``collation``,
    such as ``text.ANY_CASE``, its texts compare by that.
    """
    raw = spark.read.parquet(location) if "/" in location else spark.table(location)
    df = typed(raw, columns, zone)
    return df if collation is None else collated(df, collation)


def typed(df: DataFrame, columns: dict[str, str], zone: str | None = None) -> DataFrame:
    """Select columns by name in their declared types, without changing a value.

    A number that the declared type cannot hold exactly fails the query. A time with a
    zone becomes the local time of ``zone``, whatever the session's zone; without a
    ``zone`` such a source is refused.
    """
    kinds = dict(df.dtypes)
    return df.select(*(_exact(df, n, kinds[n], kind, zone).alias(n) for n, kind in columns.items()))


_NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
_WIDER = {("int", "bigint"), ("smallint", "int"), ("smallint", "bigint"), ("tinyint", "int"),
          ("tinyint", "bigint"), ("float", "double"), ("int", "double")}


def _exact(df: DataFrame, name: str, kind: str, wanted: str, zone: str | None) -> Column:
    value = df[f"`{name}`"]
    if kind == wanted:
        return value
    if kind == "timestamp" and wanted != "string":
        if zone is None:
            raise ValueError(f"{name} holds times with a zone: name the zone to read them in")
        return _local_time(value, zone).cast(wanted)
    cast = value.cast(wanted)
    if (kind, wanted) in _WIDER or not (kind.startswith(_NUMBERS) and wanted.startswith(_NUMBERS)):
        return cast
    same = value.try_cast(wanted).try_cast(kind).eqNullSafe(value)
    wrong = F.concat(F.lit(f"{name} does not fit {wanted}: "), value.cast("string"))
    return F.when(same, value.try_cast(wanted)).otherwise(F.raise_error(wrong).cast(wanted))


def _local_time(value: Column, zone: str) -> Column:
    """A moment as the clock in ``zone`` shows it, independent of the session's zone."""
    seconds = (F.unix_micros(value) / F.lit(1_000_000).cast("decimal(8,0)")).cast("decimal(18,6)")
    utc = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)
