"""Calendar attributes of a day and the date of Easter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratastar.functions.keys import date_key

CALENDAR_COLUMNS = (
    "date_key", "full_date", "annee", "trimestre", "mois", "jour",
    "nom_mois", "nom_jour", "numero_jour_semaine", "annee_mois_key", "annee_mois",
)


def calendar_attributes(day: Column | str) -> list[Column]:
    """The attributes of a date dimension, weekday 1 being Sunday."""
    day = F.col(day) if isinstance(day, str) else day
    values = (
        date_key(day),
        day,
        F.year(day),
        F.quarter(day),
        F.month(day),
        F.dayofmonth(day),
        F.date_format(day, "MMMM"),
        F.date_format(day, "EEEE"),
        F.dayofweek(day),
        F.year(day) * 100 + F.month(day),
        F.date_format(day, "yyyy-MM"),
    )
    return [value.alias(name) for name, value in zip(CALENDAR_COLUMNS, values, strict=True)]


def day_flag(day: Column | str) -> Column:
    """True from Monday to Friday."""
    day = F.col(day) if isinstance(day, str) else day
    return F.weekday(day) < 5


def easter_sunday(year: str) -> list[dict[str, Column]]:
    """Stages of new columns; after the last one, `easter` holds Easter Sunday of column `year`.

    Golden number, century corrections, epact and full moon, as in the classic
    almanac rule. Stages keep each expression small; apply with `withColumns`.
    """
    y = F.col(year)
    century = F.expr(f"{year} div 100 + 1")
    return [
        {"_golden": y % 19 + 1, "_century": century},
        {
            "_solar": F.expr("(3 * _century) div 4 - 12"),
            "_lunar": F.expr("(8 * _century + 5) div 25 - 5"),
        },
        {
            "_sunday": F.expr(f"(5 * {year}) div 4 - _solar - 10"),
            "_epact": F.pmod(F.expr("11 * _golden + 20 + _lunar - _solar"), F.lit(30)),
        },
        {
            "_epact": F.col("_epact")
            + F.when(((F.col("_epact") == 25) & (F.col("_golden") > 11)) | (F.col("_epact") == 24), 1).otherwise(0)
        },
        {"_moon": F.lit(44) - F.col("_epact")},
        {"_moon": F.col("_moon") + F.when(F.col("_moon") < 21, 30).otherwise(0)},
        {
            "easter": F.date_add(
                F.make_date(y.cast("int"), F.lit(3), F.lit(1)),
                (F.col("_moon") + 6 - (F.col("_sunday") + F.col("_moon")) % 7).cast("int"),
            )
        },
    ]
