"""Zones rolled up into aggregation zones."""

from pyspark.sql import functions as F

from ..functions.scalars import strip
from ..schemas import NA
from ..session import checkpointed
from .joins import lookup_join
from .reshape import pivot_variables

# Equipment kinds, in output order.
EQUIPMENT = [
    "People",
    "Lights",
    "ElectricEquipment",
    "GasEquipment",
    "OtherEquipment",
    "HotWaterEquipment",
    "SteamEquipment",
]
GAINS = " Internal Gains Nominal"

ZONE_TABLE = "Zone Information"
# Report variables that weigh a zone.
WEIGHT_VARIABLE = {"area": "Floor Area {m2}", "volume": "Volume {m3}"}

SCHEDULE = "Schedule Value"

# The first parts of output zone names.
SERIES_STEM = "Aggregation_Zone_"
EQUIPMENT_STEM = "Aggregation_Zone_Equipment_"


def zone_weights(eio):
    """Floor area and volume per building and zone, from the report rows."""
    zones = eio.filter(
        (F.col("tablename") == ZONE_TABLE)
        & F.col("variablename").isin(list(WEIGHT_VARIABLE.values()))
    )
    return zones.groupBy("buildingid", "zonename").agg(
        *[
            F.max(F.when(F.col("variablename") == name, F.col("floatvalue").cast("double"))).alias(kind)
            for kind, name in WEIGHT_VARIABLE.items()
        ]
    )


def with_aggregation_zone(rows, zone_map):
    """Rows of mapped zones with ``aggregation_zone`` (and its weights, if the map has them); others drop out."""
    kept = ["buildingid", "zonename", "aggregation_zone", *[k for k in WEIGHT_VARIABLE if k in zone_map.columns]]
    return lookup_join(rows, zone_map.select(*kept), ["buildingid", "zonename"], "inner")


SIMPLE = {"mean": F.avg, "sum": F.sum, "min": F.min, "max": F.max}
WEIGHTED = {f"{kind}_weighted": kind for kind in WEIGHT_VARIABLE}


def modes_of(how, weights):
    """The modes in ``how``, one or a list of them; an unknown one, or one that lacks its weights, is an error."""
    modes = [how] if isinstance(how, str) else list(how)
    unknown = [m for m in modes if m not in SIMPLE and m not in WEIGHTED]
    if unknown:
        raise ValueError(f"unknown aggregation {unknown}")
    if weights is None and any(m in WEIGHTED for m in modes):
        raise ValueError(f"{modes} needs weights")
    return modes


def combined(mode, value):
    """Aggregate of ``value`` by one mode; a weighted one finds the weights in the row."""
    return SIMPLE[mode](value) if mode in SIMPLE else weighted_mean(value, F.col(WEIGHTED[mode]))


def weighted_map(zone_map, weights, modes):
    """``zone_map`` with the weights that the modes need, stored once, as they come from the report rows."""
    if not any(m in WEIGHTED for m in modes):
        return zone_map
    sizes = weights.select("buildingid", "zonename", *WEIGHT_VARIABLE)
    return checkpointed(zone_map.join(sizes, ["buildingid", "zonename"], "left"))


def aggregate_zones(ts, zone_map, how="mean", weights=None, name="zonename"):
    """One series per aggregation zone and variable.

    ``zone_map`` gives the aggregation zone of each zone of a building.  With
    ``name`` set to ``surfacename`` or ``systemnodename`` it gives that of each
    surface or node, so these series collapse to one per zone as well.

    ``how`` is mean, sum, min, max, area_weighted or volume_weighted; the
    result is in ``value``.  A list of them gives one column each, from one
    pass.  The weighted means take ``weights`` (see ``zone_weights``); a zone
    without a weight, and a missing value, count in neither sum.  Every mode
    is a plain aggregate that is combined before the shuffle.
    """
    modes = modes_of(how, weights)
    zone_map = weighted_map(zone_map, weights, modes)
    value = F.col("value").cast("double")
    results = [combined(m, value).alias("value" if isinstance(how, str) else m) for m in modes]
    rows = lookup_join(ts, zone_map, ["buildingid", name], "inner", spread=["datetime"])
    series = rows.groupBy("buildingid", "aggregation_zone", "variablename", "datetime").agg(*results)
    return series.select(
        "buildingid", zone_label(), "variablename", "datetime", *series.columns[4:]
    )


def aggregate_zone_table(ts, zone_map, variables, how="mean", name="zonename", weights=None):
    """``aggregate_zones`` with one column per variable, in one shuffle.

    ``how`` is one of its modes.  Each variable is an aggregate over its own
    rows, so nothing is grouped twice.
    """
    modes = modes_of([how], weights)
    zone_map = weighted_map(zone_map, weights, modes)
    value = F.col("value").cast("double")
    rows = lookup_join(
        ts.filter(F.col("variablename").isin(list(variables))), zone_map, ["buildingid", name], "inner", spread=["datetime"]
    )
    # Zones and times of other variables only have no line here.
    table = rows.groupBy("buildingid", "aggregation_zone", "datetime").agg(
        *[combined(how, F.when(F.col("variablename") == v, value)).alias(v) for v in variables]
    )
    return table.select("buildingid", zone_label(), "datetime", *[f"`{v}`" for v in variables])


def weighted_mean(value, weight):
    """Mean of ``value`` weighed by ``weight``, over rows that have both."""
    used = F.when(value.isNotNull(), weight)
    return F.try_divide(F.sum(value * weight), F.sum(used))


def zone_label(stem=SERIES_STEM):
    """Output zone name of an aggregation zone."""
    return F.concat(F.lit(stem), F.col("aggregation_zone").cast("string")).alias("zonename")


def zone_series_table(aggregated, variables):
    """Aggregated series with one column per variable."""
    return pivot_variables(aggregated, ["buildingid", "zonename", "datetime"], variables)


def equipment_levels(eio, zone_map, variable, equipment=tuple(EQUIPMENT)):
    """One ``<Equipment>_Level`` column per aggregation zone.

    The level is the sum of the report variable ``variable`` (such as the
    number of people) over the zone's equipment.
    """
    tables = [e + GAINS for e in equipment]
    rows = eio.filter(
        F.col("tablename").isin(tables) & (F.col("variablename") == variable)
    )
    kind = F.replace(F.col("tablename"), F.lit(GAINS), F.lit(""))
    levels = (
        with_aggregation_zone(rows, zone_map)
        .withColumn("kind", kind)
        .groupBy("buildingid", "aggregation_zone")
        .pivot("kind", list(equipment))
        .agg(F.sum(F.col("floatvalue").cast("double")))
    )
    return levels.select(
        "buildingid",
        zone_label(EQUIPMENT_STEM),
        *[F.col(e).alias(f"{e}_Level") for e in equipment],
    )


def schedule_users(eio):
    """The zones that use each schedule, by kind of equipment: ``buildingid``, ``schedulename``, ``_zone``, ``_kind``."""
    tables = [e + GAINS for e in EQUIPMENT]
    named = eio.filter(F.col("tablename").isin(tables) & (F.col("variablename") == "Schedule Name"))
    return named.select(
        "buildingid",
        strip(F.col("stringvalue")).alias("schedulename"),
        F.col("zonename").alias("_zone"),
        F.replace(F.col("tablename"), F.lit(GAINS), F.lit("")).alias("_kind"),
    ).distinct()


def schedule_series(ts):
    return ts.filter((F.col("variablename") == SCHEDULE) & (F.col("schedulename") != NA))


def equipment_schedules(ts, eio):
    """Schedule series given to the zones that use them, one variable per equipment.

    The report names the schedule of each piece of equipment.  The rows come
    back with the zone filled in and the variable ``Schedule Value <Equipment>``,
    once for each zone.  To aggregate them, ``aggregate_schedules`` is the
    shorter way.
    """
    users = checkpointed(schedule_users(eio))
    joined = lookup_join(
        schedule_series(ts), users, ["buildingid", "schedulename"], "inner", spread=["datetime"]
    )
    return joined.withColumns(
        {
            "zonename": F.col("_zone"),
            "variablename": F.concat(F.lit(f"{SCHEDULE} "), F.col("_kind")),
        }
    ).select(*ts.columns)


def aggregate_schedules(ts, eio, zone_map, how="mean", weights=None):
    """``aggregate_zones`` of ``equipment_schedules``, without a row for each zone.

    All zones that share a schedule share its values.  So the zones are first
    counted, and their weights summed, per schedule, equipment and aggregation
    zone; a series row is joined once with each of these, however many zones
    there are, and counts as often as they say.
    """
    modes = modes_of(how, weights)
    users = with_aggregation_zone(
        schedule_users(eio).withColumnRenamed("_zone", "zonename"), weighted_map(zone_map, weights, modes)
    )
    kinds = [WEIGHTED[m] for m in modes if m in WEIGHTED]
    shares = checkpointed(
        users.groupBy("buildingid", "schedulename", "_kind", "aggregation_zone").agg(
            F.count(F.lit(1)).alias("_zones"), *[F.sum(k).alias(k) for k in kinds]
        )
    )
    rows = lookup_join(
        schedule_series(ts), shares, ["buildingid", "schedulename"], "inner", spread=["datetime"]
    )
    value = F.col("value").cast("double")
    counted = {"mean": weighted_mean(value, F.col("_zones")), "sum": F.sum(value * F.col("_zones"))}
    results = [
        (counted[m] if m in counted else combined(m, value)).alias("value" if isinstance(how, str) else m)
        for m in modes
    ]
    variable = F.concat(F.lit(f"{SCHEDULE} "), F.col("_kind")).alias("variablename")
    series = rows.groupBy("buildingid", "aggregation_zone", variable, "datetime").agg(*results)
    return series.select("buildingid", zone_label(), "variablename", "datetime", *series.columns[4:])
