import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import rows
from zonarium.plans import jobs
from zonarium.schemas import MANIFEST, MANIFEST_KEY, TIMESERIES_KEY
from zonarium.session import scratch_path, shared_dir
from zonarium.sources import files, tables
from zonarium.streaming.incremental import start_incremental_load

RUNS = ["ASHRAE_2013_Buffalo_Hospital", "MF_CZ2B_Tucson_gas+furnace_crawl space_IECC_2006"]
FILES = {
    "Zone_Mean_Air_Temperature": ["ZA:Zone Mean [C](TimeStep)", "Z.B:Zone Mean [C](TimeStep)"],
    "Surface_Inside_Face_Temperature": ["W1:Surface [C](TimeStep)"],
    "System_node_Temperature": ["N1:System Node [C](TimeStep)"],
    "Schedule_Value": ["S1:Schedule Value [](TimeStep)"],
    "Site_Outdoor_Air_Drybulb_Temperature": ["Environment:Site [C](TimeStep)", "X:Site"],
    "Facility_Total_HVAC_Electric_Demand_Power": ["Whole Building:Facility [W](TimeStep)"],
    "Boiler_Rate": ["B1:Boiler"],
}
SERIES_PER_RUN = 7
EIO = """Program Version,invented
! <Zone Information>,Zone Name,Floor Area {m2}
 Zone Information,ZA,12.5
 Zone Information,Z.B,N/A
"""


def write_run(root, run, steps=range(1, 4)):
    for name, headers in FILES.items():
        file = root / run / "TimeSeriesData" / f"{name}.csv"
        file.parent.mkdir(parents=True, exist_ok=True)
        lines = ["Date/Time," + ",".join(headers)]
        for s in steps:
            lines.append(f" 12/31  {21 + s:02d}:00:00," + ",".join(f"{s}.{i}" for i in range(len(headers))))
        file.write_text("\n".join(lines) + "\n")
    report = root / run / "OutputFiles" / "report.eio"
    report.parent.mkdir(parents=True, exist_ok=True)
    report.write_text(EIO)


@pytest.fixture
def setup(spark, tmp_path):
    results, models, root = tmp_path / "results", tmp_path / "models", str(tmp_path / "tables")
    models.mkdir()
    entries = []
    for i, run in enumerate(RUNS):
        write_run(results, run)
        model = models / f"m{i}.idf"
        model.write_text("x\nALL OBJECTS IN CLASS: COIL:HEATING:GAS\n" if i == 0 else "x\n")
        entries.append(("NA", str(model), "w", str(results / run), "Not Started"))
    manifest = str(tmp_path / "manifest")
    files.write_manifest(spark.createDataFrame(entries, MANIFEST), manifest)
    return spark, root, manifest, results, str(models)


def load(setup, mode=jobs.DEDUPE):
    spark, root, manifest, results, models = setup
    jobs.load_all(spark, root, manifest, str(results), models, 2012, 60, mode)
    return tables.read_table(spark, root, "timeseriesdata")


@pytest.mark.parametrize("mode", [jobs.DEDUPE, jobs.WATERMARK])
def test_load_all(setup, mode):
    spark, root, manifest, results, _ = setup
    facts = load(setup, mode)
    assert facts.count() == 2 * SERIES_PER_RUN * 3
    assert rows(facts.select("datetime").distinct()) == [
        (dt.datetime(2012, 12, 31, 22),), (dt.datetime(2012, 12, 31, 23),), (dt.datetime(2013, 1, 1),),
    ]
    assert facts.filter("variablename like 'Site%'").count() == 6
    assert facts.filter("variablename like 'Boiler%'").count() == 0
    assert rows(facts.filter("zonename <> 'NA'").select("zonename").distinct()) == [("Z.B",), ("ZA",)]
    assert facts.select("timeseriesdataid").distinct().count() == facts.count()

    buildings = tables.read_table(spark, root, "buildingids")
    assert rows(buildings.select("buildingid", "buildingcategory", "buildingheatingtype", "buildingclimatezone")) == [
        (1, "Commercial", "Gas", "5A"), (2, "Residential", "gas+furnace", "CZ2B"),
    ]
    ledger = tables.read_table(spark, root, "ledger")
    assert rows(ledger.select("status", "n_rows").distinct()) == [("Upload Completed", 3)]
    assert ledger.count() == 2 * SERIES_PER_RUN
    state = files.read_manifest(spark, manifest)
    assert rows(state.select("BuildingID", "Simulation Status")) == [("1", "Complete"), ("2", "Complete")]
    eio = tables.read_table(spark, root, "eiotabledata")
    assert rows(eio.select("buildingid", "zonename", "stringvalue", "floatvalue")) == [
        (b, z, s, v) for b in (1, 2) for z, s, v in (("Z.B", "N/A", None), ("ZA", "NA", 12.5))
    ]

    again = load(setup, mode)
    assert again.count() == 2 * SERIES_PER_RUN * 3
    assert tables.read_table(spark, root, "eiotabledata").count() == 4
    assert tables.read_table(spark, root, "buildingids").count() == 2


def test_rerun_after_a_lost_ledger_adds_no_rows(setup):
    spark, root, *_ = setup
    before = rows(load(setup))
    tables.truncate_table(spark, root, "ledger")
    assert rows(load(setup)) == before


def test_a_grown_file_is_completed(setup):
    spark, root, manifest, results, _ = setup
    load(setup)
    write_run(results, RUNS[0], range(0, 4))
    ids = spark.createDataFrame([(RUNS[0], 1)], "run string, buildingid long")
    lines = files.read_output_lines(spark, f"{results}/{RUNS[0]}/TimeSeriesData/*.csv")
    jobs.load_outputs(spark, root, lines, ids, 2012, 60, jobs.WATERMARK, skip_completed=False)
    facts = tables.read_table(spark, root, "timeseriesdata")
    assert facts.count() == 2 * SERIES_PER_RUN * 3  # the new rows are older than the mark
    jobs.load_outputs(spark, root, lines, ids, 2012, 60, jobs.DEDUPE, skip_completed=False)
    assert facts.sparkSession.read.parquet(f"{root}/timeseriesdata").count() == 2 * SERIES_PER_RUN * 3 + SERIES_PER_RUN


def test_load_variable(spark, tmp_path):
    write_run(tmp_path, RUNS[0])
    root = str(tmp_path / "t")
    tables.ensure_tables(spark, root)
    path = str(tmp_path / RUNS[0] / "TimeSeriesData" / "Zone_Mean_Air_Temperature.csv")
    for _ in range(2):
        jobs.load_variable(spark, root, path, 5, 2012, 60)
        facts = tables.read_table(spark, root, "timeseriesdata")
        assert rows(facts.groupBy("buildingid", "zonename").count()) == [(5, "Z.B", 3), (5, "ZA", 3)]


def test_incremental_load(spark, tmp_path):
    root, results = str(tmp_path / "t"), tmp_path / "results"
    tables.ensure_tables(spark, root)
    runs = spark.createDataFrame([(r, i) for i, r in enumerate(RUNS, 1)], "run string, buildingid long")

    def step():
        query = start_incremental_load(
            spark, root, f"{results}/*/TimeSeriesData/*.csv", runs, 2012, 60, str(tmp_path / "cp")
        )
        assert query.awaitTermination(180)
        return tables.read_table(spark, root, "timeseriesdata").count()

    write_run(results, RUNS[0])
    assert step() == SERIES_PER_RUN * 3
    write_run(results, RUNS[1])
    assert step() == 2 * SERIES_PER_RUN * 3
    assert step() == 2 * SERIES_PER_RUN * 3


def test_tables(spark, tmp_path):
    root = str(tmp_path / "t")
    assert tables.table_state(spark, root, "timeseriesdata") == (False, None)
    tables.ensure_tables(spark, root)
    assert tables.table_state(spark, root, "timeseriesdata") == (True, True)
    row = spark.createDataFrame(
        [(1.5, 3, dt.datetime(2024, 1, 1), 5, "V", "NA", "Z", "NA", "NA")],
        "value double, buildingid long, datetime timestamp_ntz, timeresolution int, variablename string,"
        "schedulename string, zonename string, surfacename string, systemnodename string",
    )
    tables.append_rows(row, root, "timeseriesdata")
    tables.ensure_tables(spark, root)
    assert tables.table_state(spark, root, "timeseriesdata") == (True, False)
    stored = tables.read_table(spark, root, "timeseriesdata")
    assert rows(stored.select(*TIMESERIES_KEY))[0][-1] == 1.5
    tables.truncate_table(spark, root, "timeseriesdata")
    assert tables.table_state(spark, root, "timeseriesdata") == (True, True)
    with pytest.raises(KeyError):
        tables.read_table(spark, root, "other")


def test_shared_dir_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_dir(spark)
    if configured:
        assert folder == configured.rstrip("/")
    assert spark.sparkContext.getCheckpointDir() is not None
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_published_ledger(spark, tmp_path):
    path = tmp_path / "ledger.csv"
    path.write_text(
        "BuildingID,Variable Name,Subvariable Name,Upload Status,Upload Time\n"
        "1,Schedule Value,NA,Upload Completed,0:00:00\n"
        "1,Surface X,F2 EWALL C,Upload Completed,00:43:19\n"
        "1,Surface X,NA,Upload Started,None\n"
    )
    got = files.read_ledger(spark, str(path))
    assert rows(got.select("subvariable", "status", "elapsed_seconds")) == [
        ("F2 EWALL C", "Upload Completed", 2599), ("NA", "Upload Completed", 0), ("NA", "Upload Started", None),
    ]


def test_model_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x y+z.idf").write_text("l1\nALL OBJECTS IN CLASS: COIL:HEATING:GAS\nALL OBJECTS IN CLASS: COIL:HEATING:WATER\n")
    (tmp_path / "b.idf").write_text("none\n")
    (tmp_path / "c.txt").write_text("ALL OBJECTS IN CLASS: COIL:HEATING:GAS\n")
    got = files.model_heating(spark, str(tmp_path)).select(F.substring_index("file", "/", -1), "heating")
    assert rows(got) == [("b.idf", ""), ("x y+z.idf", "Water & Gas")]
    assert files.read_model_text(spark, str(tmp_path)).count() == 2


def test_column_names_and_bundle(spark, tmp_path):
    write_run(tmp_path, RUNS[0])
    headers, _ = files.read_output_csv(spark, f"{tmp_path}/*/TimeSeriesData/*.csv")
    assert headers.select("run", "variablename").count() == len(FILES)
    out = str(tmp_path / "names")
    files.write_column_names(headers, out)
    assert spark.read.text(out).count() == sum(map(len, FILES.values()))
    frame = files.read_output_frame(
        spark, str(tmp_path / RUNS[0] / "TimeSeriesData" / "Zone_Mean_Air_Temperature.csv"),
        ["Date/Time", *FILES["Zone_Mean_Air_Temperature"]],
    )
    assert frame.count() == 3
    long = spark.range(4).select(F.col("id").alias("buildingid"), F.lit("V W").alias("variablename"), F.lit(1).alias("datetime"), F.lit(1.0).alias("value"))
    files.write_bundle(long, str(tmp_path / "bundle"))
    assert rows(spark.read.parquet(str(tmp_path / "bundle")).select("buildingid", "variablename")) == [
        (i, "V W") for i in range(4)
    ]
