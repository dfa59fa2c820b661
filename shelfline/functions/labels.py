"""Calendar keys, period labels and code lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: Julian day number of 1970-01-01.
UNIX_EPOCH_JULIAN_DAY = 2440588

# Ship mode codes and their names; any other code is 'Other'.
SHIP_METHODS = {1: "Standard", 2: "Air", 3: "Truck", 4: "Mail"}
OTHER_SHIP_METHOD = "Other"


def julian_day(day: Column) -> Column:
    """Date surrogate key: the Julian day number."""
    return (F.unix_date(day) + UNIX_EPOCH_JULIAN_DAY).cast("bigint")


def day_of_week_num(day: Column) -> Column:
    """0 for Sunday to 6 for Saturday."""
    return (F.dayofweek(day) - 1).cast("bigint")


def week_start(day: Column) -> Column:
    """The Sunday on or before ``day``."""
    return F.date_sub(day, F.dayofweek(day) - 1)


def month_label(day: Column) -> Column:
    """``2000-02``."""
    return F.date_format(day, "yyyy-MM")


def quarter_label(day: Column) -> Column:
    """``2000 Q1``."""
    return F.concat(
        F.year(day).cast("string"), F.lit(" Q"), F.quarter(day).cast("string")
    )


def ship_method(code: Column) -> Column:
    """Name of a ship mode code."""
    named = F
    for number, name in SHIP_METHODS.items():
        named = named.when(code == number, name)
    return named.otherwise(OTHER_SHIP_METHOD)
