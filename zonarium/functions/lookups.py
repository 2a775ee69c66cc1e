"""Location and climate-zone lookups."""

from itertools import chain

from pyspark.sql import functions as F

UNKNOWN = "Unknown"

# Location of a commercial building -> climate zone.
CLIMATE_ZONE_OF_LOCATION = {
    "HoChiMinh": "0A",
    "Dubai": "0B",
    "Miami": "1A",
    "Honolulu": "1A",
    "NewDehli": "1B",
    "Tampa": "2A",
    "Tucson": "2B",
    "Atlanta": "3A",
    "ElPaso": "3B",
    "SanDiego": "3C",
    "NewYork": "4A",
    "Albuquerque": "4B",
    "Seattle": "4C",
    "Buffalo": "5A",
    "Denver": "5B",
    "PortAngeles": "5C",
    "Rochester": "6A",
    "GreatFalls": "6B",
    "InternationalFalls": "7",
    "Fairbanks": "8",
}

# Climate-zone code of a residential model -> location.
LOCATION_OF_CLIMATE_ZONE = {
    "CZ1AWH": "Miami",
    "CZ1AWHT": "Honolulu",
    "CZ1AWHTS": "Honolulu",
    "CZ2AWH": "Tampa",
    "CZ2B": "Tucson",
    "CZ3A": "Atlanta",
    "CZ3AWH": "Montgomery",
    "CZ3B": "ElPaso",
    "CZ3C": "SanDiego",
    "CZ4A": "NewYork",
    "CZ4B": "Albuquerque",
    "CZ4C": "Seattle",
    "CZ5A": "Buffalo",
    "CZ5B": "Denver",
    "CZ5C": "PortAngeles",
    "CZ6A": "Rochester",
    "CZ6B": "GreatFalls",
    "CZ7": "InternationalFalls",
    "CZ8": "Fairbanks",
}


def _lookup(table, key):
    pairs = F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])
    return F.coalesce(F.try_element_at(pairs, key), F.lit(UNKNOWN))


def climate_zone(location):
    """Climate zone of a commercial building's location, else ``Unknown``."""
    return _lookup(CLIMATE_ZONE_OF_LOCATION, location)


def location(zone_code):
    """Location of a residential climate-zone code, else ``Unknown``."""
    return _lookup(LOCATION_OF_CLIMATE_ZONE, zone_code)
