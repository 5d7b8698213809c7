"""Keys and audit columns."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlens.rules import SOURCE_SYSTEM

SEPARATOR = "||"


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*parts: str | Column) -> Column:
    """MD5 of the parts as text; a NULL part counts as an empty string."""
    text = [F.coalesce(_column(p).cast("string"), F.lit("")) for p in parts]
    return F.md5(F.concat_ws(SEPARATOR, *text))


def mart_key(*parts: str | Column) -> Column:
    """MD5 of the parts as text; a NULL part is left out altogether."""
    return F.md5(F.concat_ws(SEPARATOR, *[_column(p).cast("string") for p in parts]))


def company_name() -> Column:
    return F.coalesce("co_name", "company")


def company_domain() -> Column:
    return F.coalesce("co_domain", "company_domain")


def company_id() -> Column:
    """Native id, else a hash of the same name and domain the dimension shows."""
    return F.coalesce("co_id", surrogate_key(company_domain(), company_name()))


def location_id() -> Column:
    return F.coalesce(F.col("loc_id").cast("string"), surrogate_key("location"))


def with_audit(df: DataFrame, at: datetime | None = None, source: str = SOURCE_SYSTEM) -> DataFrame:
    """Add ``created_date`` and ``source_system``; ``at`` replaces the clock."""
    stamp = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    return df.withColumns({"created_date": stamp, "source_system": F.lit(source)})


def with_business_date(df: DataFrame, as_of: date | None = None, source: str = SOURCE_SYSTEM) -> DataFrame:
    """Add ``business_date`` (day of the run) and ``source_system``."""
    day = F.current_date() if as_of is None else F.lit(as_of)
    return df.withColumns({"business_date": day, "source_system": F.lit(source)})
