"""Run names, building names and heating tags."""

from pyspark.sql import functions as F

from ..schemas import BUILDING_ATTRIBUTES, NA
from .lookups import climate_zone, location
from .scalars import basename

COMMERCIAL, RESIDENTIAL, MANUFACTURED = "Commercial", "Residential", "Manufactured"

# Marker lines of the heating coils, in output order.
HEATING_MARKERS = {
    "Water": "ALL OBJECTS IN CLASS: COIL:HEATING:WATER",
    "Electric": "ALL OBJECTS IN CLASS: COIL:HEATING:ELECTRIC",
    "Steam": "ALL OBJECTS IN CLASS: COIL:HEATING:STEAM",
    "Gas": "ALL OBJECTS IN CLASS: COIL:HEATING:GAS",
}

# Models known not to run.
BROKEN_PREFIXES = ["MS", "SS"]
BROKEN_WORDS = ["heatedbsmt", "slab", "officeLarge"]


# Model file names, as far as they are used.
# Commercial: standard, type, three letters and the year, location.
_COMMERCIAL_FILE = r"^(ASHRAE|IECC)[^_]*_([^_]*)_[^_]{0,3}([^_]*)_([^_]*)(?:_.*)?$"
# Residential: prototype, climate zone, heating, foundation, standard and year.
_RESIDENTIAL_FILE = r"^US[^+]*\+([^+]*)\+([^+]*)\+([^+]*)\+([^+]*)\+([^+]*)(?:\+.*)?$"


def run_name(model_file):
    """Run name of a model file; NULL when the file name lacks a part."""
    stem = F.replace(basename(model_file), F.lit(".idf"), F.lit(""))
    code = F.regexp_extract(stem, _RESIDENTIAL_FILE, 2)
    return (
        F.when(
            stem.startswith("ASHRAE") | stem.startswith("IECC"),
            F.when(
                stem.rlike(_COMMERCIAL_FILE),
                F.regexp_replace(stem, _COMMERCIAL_FILE, "$1_$3_$4_$2"),
            ),
        )
        .when(
            stem.startswith("US"),
            F.when(
                stem.rlike(_RESIDENTIAL_FILE),
                F.concat(
                    F.regexp_replace(stem, _RESIDENTIAL_FILE, "$1_$2_"),
                    location(code),
                    F.regexp_replace(stem, _RESIDENTIAL_FILE, "_$3_$4_$5"),
                ),
            ),
        )
        .otherwise(stem)
    )


def building_category(results_folder):
    """Commercial, Residential or Manufactured, from the run name."""
    name = basename(results_folder)
    return (
        F.when(name.startswith("ASHRAE") | name.startswith("IECC"), COMMERCIAL)
        .when(name.startswith("MF") | name.startswith("SF"), RESIDENTIAL)
        .otherwise(MANUFACTURED)
    )


# Position of each attribute in the run name, per category.
_POSITIONS = {
    COMMERCIAL: {
        "buildingstandard": 0,
        "buildingstandardyear": 1,
        "buildinglocation": 2,
        "buildingtype": 3,
    },
    RESIDENTIAL: {
        "buildingprototype": 0,
        "buildingclimatezone": 1,
        "buildinglocation": 2,
        "buildingheatingtype": 3,
        "buildingfoundationtype": 4,
        "buildingstandard": 5,
        "buildingstandardyear": 6,
    },
    # The energy code of a manufactured home is kept as its standard.
    MANUFACTURED: {
        "buildingconfiguration": 0,
        "buildinglocation": 1,
        "buildingclimatezone": 2,
        "buildingstandard": 3,
        "buildingheatingtype": 4,
    },
}


def with_building_attributes(runs, folder, heating):
    """``runs`` with the ten building columns, ``'NA'`` where the name lacks a part.

    ``folder`` names the column of the results folder, whose last part is the
    run name.  ``heating`` names the column of the model's heating tags; only
    commercial buildings use it, the other names carry their heating type.
    """
    parts, category, place = F.col("_parts"), F.col("_category"), F.get("_parts", F.lit(2))
    values = {
        kind: {name: F.get(parts, F.lit(i)) for name, i in where.items()}
        for kind, where in _POSITIONS.items()
    }
    values[COMMERCIAL]["buildingclimatezone"] = F.when(place.isNotNull(), climate_zone(place))
    values[COMMERCIAL]["buildingheatingtype"] = F.coalesce(heating, F.lit(""))

    columns = [category.alias("buildingcategory")]
    for name in BUILDING_ATTRIBUTES[1:]:
        options = [
            F.when(category == kind, found[name])
            for kind, found in values.items()
            if name in found
        ]
        columns.append(F.coalesce(*options, F.lit(NA)).alias(name))
    # The name is split once, before the ten columns are taken from it.
    split = runs.withColumns(
        {
            "_parts": F.split(basename(F.col(folder)), "_"),
            "_category": building_category(F.col(folder)),
        }
    )
    return split.select(*runs.columns, *columns)


def heating_tags(text):
    """Heating tags found in a model text, joined by `` & `` in fixed order."""
    return F.concat_ws(
        " & ", *[F.when(text.contains(mark), tag) for tag, mark in HEATING_MARKERS.items()]
    )


def is_broken_model(model_file):
    """Whether a model file is one of those known not to run."""
    name = basename(model_file)
    broken = F.lit(False)
    for prefix in BROKEN_PREFIXES:
        broken = broken | name.startswith(prefix)
    for word in BROKEN_WORDS:
        broken = broken | name.contains(word)
    return broken
