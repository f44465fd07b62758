"""Hash surrogate keys and integer date keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The unknown member and the text hashed for a missing key part.
UNKNOWN = "__UNKNOWN__"
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def surrogate_key(*parts: Column | str, algorithm: str = "sha256", null_token: str = NULL_TOKEN) -> Column:
    """Hash over the parts, each as text, joined by '-'; NULL parts hash as the token.

    Strings name columns; pass `lit(...)` for a constant part.
    """
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    text = F.concat_ws(SEPARATOR, *[F.coalesce(c.cast("string"), F.lit(null_token)) for c in columns])
    if algorithm == "md5":
        return F.md5(text)
    if algorithm == "sha256":
        return F.sha2(text, 256)
    raise ValueError(f"unknown key algorithm: {algorithm}")


def unknown_key(*scope: str) -> Column:
    """Key of the unknown member, optionally inside a scope such as a status domain."""
    return surrogate_key(*[F.lit(s) for s in scope], F.lit(UNKNOWN))


def date_key(day: Column | str) -> Column:
    """yyyymmdd as an integer; NULL stays NULL."""
    day = F.col(day) if isinstance(day, str) else day
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def month_start(year: Column | str, month: Column | str) -> Column:
    """First day of a month; NULL when a part is missing or the month does not exist."""
    year = F.col(year) if isinstance(year, str) else year
    month = F.col(month) if isinstance(month, str) else month
    return F.when(month.between(1, 12) & year.between(1, 9999), F.make_date(year, month, F.lit(1)))
