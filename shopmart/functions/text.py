"""Text clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented letters and their plain forms, position by position.
ACCENTED = "áàâãäéèêëíìîïóòôõöúùûüç"
PLAIN = "aaaaaeeeeiiiiooooouuuuc"

# What may follow a city name ("lages - sc", "auriflama/sp",
# "rio de janeiro, brasil").
CITY_SUFFIX_MARKS = (" - ", "/", ",")


def blank_to_null(col: Column) -> Column:
    """Trim, and turn an empty result into NULL."""
    return F.nullif(F.trim(col), F.lit(""))


def clean_city_name(col: Column) -> Column:
    """Lower-case, accent-free city name without state or country suffix."""
    name = F.translate(F.lower(col), ACCENTED, PLAIN)
    for mark in CITY_SUFFIX_MARKS:
        name = F.split_part(name, F.lit(mark), F.lit(1))
    return blank_to_null(name)


def state_code(col: Column) -> Column:
    return F.upper(F.trim(col))
