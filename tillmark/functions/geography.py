"""Continents from country ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillmark.functions.parsing import whole_number

# Continent ids (the first two digits of a country id) and their names.
CONTINENTS = {
    11: "Europe",
    22: "Africa",
    33: "Asia",
    44: "Australia and Oceania",
    55: "North America",
    66: "South America",
    13: "Europe/Asia",
    10: "Europe/Worldwide",
    50: "North America/Worldwide",
}
UNKNOWN_CONTINENT = "Unknown"


def continent_id(country_id: Column) -> Column:
    return whole_number(F.substring(country_id, 1, 2))


def continent_name(continent: Column) -> Column:
    """Name of a continent id; ``Unknown`` for other ids and for NULL."""
    names = F.create_map(*[F.lit(item) for pair in CONTINENTS.items() for item in pair])
    return F.coalesce(F.try_element_at(names, continent), F.lit(UNKNOWN_CONTINENT))
