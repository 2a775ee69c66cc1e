import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from zonarium.functions import lookups, names, scalars


def values(spark, texts, expr, schema="t string"):
    df = spark.createDataFrame([(t,) for t in texts], schema)
    return [r[0] for r in df.coalesce(1).select(expr(F.col("t"))).collect()]


def test_format_datetime(spark):
    texts = [
        "08/13  14:30:00",
        " 05/01  00:05:00",
        " 12/31  24:00:00",
        "5/1  9:05:00 ",
        "02/29  01:00:00",
        "08/13 14:30:00",
        "garbage",
        "08/13  25:00:00",
        None,
    ]
    got = values(spark, texts, lambda c: scalars.format_datetime(2024, c))
    assert got == [
        dt.datetime(2024, 8, 13, 14, 30),
        dt.datetime(2024, 5, 1, 0, 5),
        dt.datetime(2025, 1, 1),
        dt.datetime(2024, 5, 1, 9, 5),
        dt.datetime(2024, 2, 29, 1),
        None,
        None,
        None,
        None,
    ]
    assert values(spark, ["02/29  01:00:00"], lambda c: scalars.format_datetime(2023, c)) == [None]


def test_seconds_to_hhmmss_does_not_wrap(spark):
    got = values(spark, [0, 59, 3661, 2690, 360000 + 61], scalars.seconds_to_hhmmss, "t long")
    assert got == ["00:00:00", "00:00:59", "01:01:01", "00:44:50", "100:01:01"]


def test_hhmmss_to_seconds(spark):
    got = values(spark, ["0:44:50", "00:43:19", "None", "100:00:01"], scalars.hhmmss_to_seconds)
    assert got == [2690, 2599, None, 360001]


@pytest.mark.parametrize(
    "text,number",
    [
        ("1e5", 1e5),
        (" 1.5 ", 1.5),
        ("1_000", 1000.0),
        ("-.5", -0.5),
        ("7.", 7.0),
        ("inf", math.inf),
        ("-Infinity", -math.inf),
        ("1.0f", None),
        ("N/A", None),
        ("", None),
        ("1d", None),
        ("0x1", None),
        ("1 2", None),
        ("_1", None),
    ],
)
def test_number_or_text(spark, text, number):
    df = spark.createDataFrame([(text,)], "t string")
    string, value = df.select(*scalars.number_or_text(F.col("t"))).first()
    assert value == number
    assert string == ("NA" if number is not None else text)


def test_nan_is_a_number(spark):
    for text in ("nan", "-NaN", " nan "):
        string, value = (
            spark.createDataFrame([(text,)], "t string")
            .select(*scalars.number_or_text(F.col("t")))
            .first()
        )
        assert string == "NA" and math.isnan(value)


def test_variable_names_and_families(spark):
    texts = [
        "Schedule_Value.csv",
        "Facility_Total_HVAC_Electric_Demand_Power",
        "Site Outdoor Air Drybulb Temperature",
        "Zone_Mean_Air_Temperature",
        "Surface_Inside_Face_Temperature",
        "System_node_Temperature",
        "System Node Temperature",
        "Boiler_Rate",
        "Schedule Value Extra",
    ]
    assert values(spark, texts, scalars.variable_family) == [
        "schedule", "site", "site", "zone", "surface", "node", None, None, None,
    ]
    assert values(spark, texts[:2], scalars.normalise_variable) == [
        "Schedule Value", "Facility Total HVAC Electric Demand Power",
    ]
    assert values(spark, ["Zone Mean"], scalars.variable_filename) == ["Zone_Mean.csv"]


def test_subvariable(spark):
    texts = ["ZONE A:Zone Mean [C](TimeStep)", " Z.B : x:y", "plain"]
    assert values(spark, texts, scalars.subvariable) == ["ZONE A", "Z.B", "plain"]


def test_basename(spark):
    texts = ["/a/b/c.idf", "D:\\x\\y.idf", "z.idf", "C:\\m/n\\o"]
    assert values(spark, texts, scalars.basename) == ["c.idf", "y.idf", "z.idf", "o"]


def test_lookup_tables(spark):
    zones = lookups.CLIMATE_ZONE_OF_LOCATION
    places = lookups.LOCATION_OF_CLIMATE_ZONE
    assert len(zones) == 20 and len(places) == 19
    assert values(spark, [*zones, "Paris", None], lookups.climate_zone) == [
        *zones.values(), "Unknown", "Unknown",
    ]
    assert values(spark, [*places, "CZ9"], lookups.location) == [*places.values(), "Unknown"]


def test_weather_names(spark):
    got = values(spark, ["USA_CA_San.Diego.epw", "USA_San.Francisco.epw"], scalars.normalise_weather)
    assert got == ["USA_CA_SanDiego.epw", "USA_San.Francisco.epw"]
    got = values(
        spark,
        ["USA_San.Francisco_El.Paso.epw", "San.Diego"],
        lambda c: scalars.normalise_weather(c, scalars.WEATHER_WORDS_MANUFACTURED),
    )
    assert got == ["USA_SanFrancisco_ElPaso.epw", "San.Diego"]


def test_run_name(spark):
    texts = [
        "D:\\m\\ASHRAE901_Hospital_STD2013_Buffalo.idf",
        "/m/IECC_OfficeSmall_STD2006_Denver.idf",
        "US+MF+CZ2B+gasfurnace+crawlspace+IECC_2006.idf",
        "US+SF+CZ0+x+y+IECC_2006.idf",
        "MS_ElPaso_3B_CodeX_gasfurnace.idf",
        "Custom.idf",
        "ASHRAE901_Hospital.idf",
    ]
    assert values(spark, texts, names.run_name) == [
        "ASHRAE_2013_Buffalo_Hospital",
        "IECC_2006_Denver_OfficeSmall",
        "MF_CZ2B_Tucson_gasfurnace_crawlspace_IECC_2006",
        "SF_CZ0_Unknown_x_y_IECC_2006",
        "MS_ElPaso_3B_CodeX_gasfurnace",
        "Custom",
        None,
    ]


def test_building_attributes(spark):
    df = spark.createDataFrame(
        [
            ("/r/ASHRAE_2013_Buffalo_Hospital", "Water & Gas"),
            ("/r/IECC_2006_Paris_Office", None),
            ("/r/MF_CZ2B_Tucson_gasfurnace_crawlspace_IECC_2006", None),
            ("/r/SF_CZ8_Fairbanks_hp_slab_IECC_2012", None),
            ("/r/MS_ElPaso_3B_CodeX_gasfurnace", "Water"),
            ("/r/Custom", None),
        ],
        "folder string, heating string",
    )
    got = [
        tuple(r)
        for r in names.with_building_attributes(df.coalesce(1), "folder", "heating")
        .drop("folder", "heating")
        .collect()
    ]
    # category, type, standard, year, location, heating, foundation, zone, prototype, configuration
    assert got == [
        ("Commercial", "Hospital", "ASHRAE", "2013", "Buffalo", "Water & Gas", "NA", "5A", "NA", "NA"),
        ("Commercial", "Office", "IECC", "2006", "Paris", "", "NA", "Unknown", "NA", "NA"),
        ("Residential", "NA", "IECC", "2006", "Tucson", "gasfurnace", "crawlspace", "CZ2B", "MF", "NA"),
        ("Residential", "NA", "IECC", "2012", "Fairbanks", "hp", "slab", "CZ8", "SF", "NA"),
        ("Manufactured", "NA", "CodeX", "NA", "ElPaso", "gasfurnace", "NA", "3B", "NA", "MS"),
        ("Manufactured", "NA", "NA", "NA", "NA", "NA", "NA", "NA", "NA", "Custom"),
    ]


def test_heating_tags(spark):
    mark = "ALL OBJECTS IN CLASS: COIL:HEATING:"
    texts = [
        "nothing",
        f"x\n{mark}GAS\n",
        f"{mark}GAS\n{mark}STEAM\n{mark}WATER\n{mark}ELECTRIC\n{mark}WATER",
    ]
    assert values(spark, texts, names.heating_tags) == [
        "", "Gas", "Water & Electric & Steam & Gas",
    ]


def test_broken_models(spark):
    texts = ["/a/MS_x.idf", "SS.idf", "/MS/ok.idf", "a_heatedbsmt.idf", "slabx", "officeLarge", "officelarge"]
    assert values(spark, texts, names.is_broken_model) == [
        True, True, False, True, True, True, False,
    ]
