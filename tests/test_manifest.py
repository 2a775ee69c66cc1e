import pytest
from pyspark.sql import functions as F

from helpers import rows
from zonarium.operators import manifest as m
from zonarium.plans.jobs import build_manifest
from zonarium.schemas import MANIFEST, MANIFEST_KEY
from zonarium.sources.files import list_models, list_weather, read_manifest, write_manifest


def frame(spark, data):
    return spark.createDataFrame(data, MANIFEST)


def base(spark):
    return frame(
        spark,
        [
            ("NA", "/m/a.idf", "w1", "/r/A", "Not Started"),
            ("NA", "/m/a.idf", "w2", "/r/A", "Not Started"),
            ("7", "/m/b.idf", "w1", "/r/B", "Uploaded"),
            ("NA", "/m/c.idf", "w1", "/r/C", "Complete"),
        ],
    )


def test_update_manifest(spark):
    updates = spark.createDataFrame([("/r/A", "Complete"), ("/r/Z", "x")], [MANIFEST_KEY, "value"])
    got = rows(m.update_manifest(base(spark), updates, "Simulation Status").select(MANIFEST_KEY, "Simulation Status"))
    assert got == [("/r/A", "Complete"), ("/r/A", "Complete"), ("/r/B", "Uploaded"), ("/r/C", "Complete")]
    got = m.update_manifest(base(spark), updates, "Completed Simulation Folderpath")
    assert sorted({r[3] for r in got.collect()}) == ["/r/B", "/r/C", "Complete"]
    with pytest.raises(KeyError):
        m.update_manifest(base(spark), updates, "Nothing")


def test_status_and_id_filters(spark):
    assert rows(m.pending_runs(base(spark)).select(MANIFEST_KEY)) == [("/r/A",), ("/r/A",), ("/r/C",)]
    assert rows(m.has_building(base(spark)).select(MANIFEST_KEY)) == [("/r/B",)]


def test_drop_broken_models(spark):
    names = ["MS_a", "SS_a", "x_heatedbsmt", "slab_x", "a_officeLarge", "a_officelarge", "MF_ok"]
    data = frame(spark, [("NA", f"D:\\m\\{n}.idf", "w", n, "s") for n in names])
    assert rows(m.drop_broken_models(data).select(MANIFEST_KEY)) == [("MF_ok",), ("a_officelarge",)]


def test_match_weather_equals_testing_all_pairs(spark):
    models = spark.createDataFrame(
        [("m1", "Buffalo"), ("m2", "Denver"), ("m3", "Den"), ("m4", "Paris"), ("m5", "a"), ("m6", None), ("m7", "Denver")],
        "model_path string, location string",
    )
    weather = spark.createDataFrame(
        [("/w/USA_NY_Buffalo.epw",), ("/w/Denver_Denver.epw",), ("/w/x",), ("/w/USA_NY_Buffalo.epw",)],
        "weather_path string",
    )
    got = rows(m.match_weather(models, weather, on_kind=False).select("model_path", "weather_path"))
    pairs = [(a.model_path, b.weather_path) for a in models.collect() for b in weather.distinct().collect()
             if a.location is not None and a.location in b.weather_path]
    assert got == sorted(pairs, key=repr)


def test_match_weather_empty_location_matches_all(spark):
    models = spark.createDataFrame([("m", "")], "model_path string, location string")
    weather = spark.createDataFrame([("/w/a",), ("/w/b",)], "weather_path string")
    assert m.match_weather(models, weather, on_kind=False).count() == 2


def make_tree(root):
    for path in (
        "Commercial_Prototypes/ASHRAE/90_1_2013/ASHRAE901_Hospital_STD2013_SanDiego.idf",
        "Commercial_Prototypes/ASHRAE/90_1_2013/ASHRAE901_OfficeLarge_STD2013_Denver.idf",
        "Commercial_Prototypes/ASHRAE/90_1_2013/notes.txt",
        "Residential_Prototypes/IECC/CZ2B/US+MF+CZ2B+gasfurnace+crawlspace+IECC_2006.idf",
        "Residential_Prototypes/IECC/CZ2B/US+MF+CZ2B+gasfurnace+slab+IECC_2006.idf",
        "Manufactured_Prototypes/x/y/MS_ElPaso_3B_CodeX_gasfurnace.idf",
        "Manufactured_Prototypes/x/y/Other_ElPaso_3B_CodeX_gasfurnace.idf",
        "TMY3_WeatherFiles_Commercial/USA_CA_San.Diego.epw",
        "TMY3_WeatherFiles_Commercial/USA_CO_Denver.1.epw",
        "TMY3_WeatherFiles_Commercial/USA_CO_Denver.2.epw",
        "TMY3_WeatherFiles_Residential/USA_AZ_Tucson.epw",
        "TMY3_WeatherFiles_Manufactured/USA_TX_El.Paso.epw",
    ):
        file = root / path
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text("model\n")


def test_build_manifest(spark, tmp_path):
    root = tmp_path / "data"
    make_tree(root)
    assert list_models(spark, str(root)).count() == 6
    assert rows(list_weather(spark, str(root)).filter("kind = 'Manufactured'").select(F.substring_index("weather_path", "/", -1))) == [("USA_TX_ElPaso.epw",)]
    manifest = build_manifest(spark, str(root), "/results/")
    got = rows(manifest.select("BuildingID", MANIFEST_KEY, F.substring_index("Weather Filepath", "/", -1), "Simulation Status"))
    assert got == [
        ("NA", "/results/ASHRAE_2013_Denver_OfficeLarge", "USA_CO_Denver.1.epw", "Not Started"),
        ("NA", "/results/ASHRAE_2013_Denver_OfficeLarge", "USA_CO_Denver.2.epw", "Not Started"),
        ("NA", "/results/ASHRAE_2013_SanDiego_Hospital", "USA_CA_SanDiego.epw", "Not Started"),
        ("NA", "/results/MF_CZ2B_Tucson_gasfurnace_crawlspace_IECC_2006", "USA_AZ_Tucson.epw", "Not Started"),
        ("NA", "/results/Other_ElPaso_3B_CodeX_gasfurnace", "USA_TX_ElPaso.epw", "Not Started"),
    ]
    path = str(tmp_path / "manifest")
    write_manifest(manifest, path)
    assert rows(read_manifest(spark, path)) == rows(manifest)
