"""Column expressions for keys, lenient parsing and deterministic ids. None of them raises on bad input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Key columns of each feed's row fingerprint.
ROW_HASH_KEYS = {
    "registry": ["vin", "model", "mfg_year", "fuel_type"],
    "assignment": ["vin", "driver_id", "start_timestamp", "daily_rate"],
    "fuel": ["transaction_id", "vin", "timestamp"],
    "maintenance": ["vin", "service_date", "service_type"],
}


def key(c: str | Column) -> Column:
    """Trimmed upper-case key; blank counts as null."""
    c = F.upper(F.trim(F.col(c) if isinstance(c, str) else c))
    return F.when(c != "", c)


def blank(c: str) -> Column:
    return F.coalesce(F.trim(F.col(c)) == "", F.lit(True))


def number(c: str, kind: str = "double") -> Column:
    return F.col(c).try_cast(kind)


def lenient_timestamp(c: str, formats: tuple[str, ...] = ()) -> Column:
    """A text as a timestamp, by the usual form or the first given format that fits; null where none does."""
    return F.coalesce(F.try_to_timestamp(F.col(c)), *(F.try_to_timestamp(F.col(c), F.lit(f)) for f in formats))


def lenient_date(c: str, formats: tuple[str, ...] = ()) -> Column:
    return F.to_date(lenient_timestamp(c, formats))


def epoch_date(c: str) -> Column:
    return F.to_date(F.timestamp_seconds(F.col(c).try_cast("long")))


def _parts(columns: list[str]) -> list[Column]:
    return [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in columns]


def row_hash(columns: list[str]) -> Column:
    """md5 over the columns joined by two pipes; a null takes an empty place, so nulls in different places differ."""
    return F.md5(F.concat_ws("||", *_parts(columns)).cast("binary"))


def surrogate_id(columns: list[str]) -> Column:
    """sha256 over the columns joined by one pipe."""
    return F.sha2(F.concat_ws("|", *_parts(columns)).cast("binary"), 256)
