"""Calendar expressions: months, weekdays, Brazilian holidays, Black Friday."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# National holidays on a fixed day, as (month, day, name).
FIXED_HOLIDAYS = (
    (1, 1, "Confraternização Universal"),
    (4, 21, "Tiradentes"),
    (5, 1, "Dia do Trabalho"),
    (9, 7, "Independência do Brasil"),
    (10, 12, "Nossa Senhora Aparecida"),
    (11, 2, "Finados"),
    (11, 15, "Proclamação da República"),
    (12, 25, "Natal"),
)

# Holidays that move with Easter Sunday, as (days after, name).
EASTER_HOLIDAYS = (
    (-48, "Carnaval"),
    (-47, "Carnaval"),
    (-2, "Sexta-feira Santa"),
    (60, "Corpus Christi"),
)


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def iso_weekday(day: Column) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return F.weekday(day) + F.lit(1)


def months_between_starts(later: Column, earlier: Column) -> Column:
    """Whole calendar months from ``earlier`` to ``later``."""
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter: the Sunday after the Paschal full moon of ``year``."""
    century = F.floor(year / 100)
    golden = year % 19
    # Age of the moon on 1 March, with the solar and lunar century corrections.
    lunar_shift = century - F.floor(century / 4) - F.floor((century * 8 + 13) / 25)
    epact = F.pmod(lunar_shift + golden * 19 + 15, F.lit(30))
    late = (epact == 29) | ((epact == 28) & (golden > 10))
    full_moon = F.date_add(
        F.make_date(year, F.lit(3), F.lit(21)),
        (epact - F.when(late, 1).otherwise(0)).cast("int"),
    )
    return F.next_day(full_moon, "Sun")


def holiday_name(day: Column) -> Column:
    """Name of the national holiday on ``day``, or NULL.

    Where a moving holiday meets a fixed one the fixed name is kept, so a day
    always has one name.
    """
    names = [
        F.when((F.month(day) == month) & (F.dayofmonth(day) == dom), F.lit(name))
        for month, dom, name in FIXED_HOLIDAYS
    ]
    easter = easter_sunday(F.year(day))
    names += [
        F.when(day == F.date_add(easter, shift), F.lit(name)) for shift, name in EASTER_HOLIDAYS
    ]
    return F.coalesce(*names)


def is_black_friday(day: Column) -> Column:
    """The Friday between 22 and 28 November."""
    rule = (F.month(day) == 11) & (iso_weekday(day) == 5) & F.dayofmonth(day).between(22, 28)
    return F.coalesce(rule, F.lit(False))
