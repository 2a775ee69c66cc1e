"""Headers count from their place on, whatever splits a file is read in; loads read what they need."""

import io
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from helpers import rows
from zonarium.operators import loading
from zonarium.plans import jobs
from zonarium.schemas import LEDGER, MANIFEST
from zonarium.sources import files, tables
from zonarium.sources.folders import any_path

RUN = "ASHRAE_2013_Buffalo_Hospital"


def write(path, kinds):
    path.parent.mkdir(parents=True, exist_ok=True)
    lines = [" 01/01  01:00:00,9"]
    for kind, hours in kinds:
        lines += [f"Date/Time,{kind}:Zone Air [C]"] + [f" 02/{d:02d}  {h:02d}:00:00,{h}" for d in range(1, 28) for h in hours]
    path.write_text("\n".join(lines) + "\n")


def load(spark, root, pattern, mode=jobs.DEDUPE, **options):
    tables.ensure_tables(spark, root)
    runs = spark.createDataFrame([(RUN, 4)], "run string, buildingid long")
    jobs.load_outputs(spark, root, files.read_output_lines(spark, pattern), runs, 2012, 60, mode, **options)
    return tables.read_table(spark, root, "timeseriesdata")


def test_a_header_in_the_middle_of_a_split_file(spark, tmp_path):
    write(tmp_path / RUN / "TimeSeriesData" / "Zone_Air.csv", [("ZA", range(1, 9)), ("ZB", range(9, 17)), ("ZA", range(17, 24))])
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k in before:
        spark.conf.set(k, "700")
    try:
        pattern = f"{tmp_path}/*/TimeSeriesData/*.csv"
        assert files.read_output_lines(spark, pattern).rdd.getNumPartitions() > 8
        facts = load(spark, str(tmp_path / "t"), pattern)
        got = facts.groupBy("zonename").agg(F.sort_array(F.collect_set(F.hour("datetime"))), F.count("*"))
        assert rows(got) == [("ZA", [*range(1, 9), *range(17, 24)], 27 * 15), ("ZB", list(range(9, 17)), 27 * 8)]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    lost = tables.read_rejected(spark, str(tmp_path / "t"), "timeseries_rejected")
    assert rows(lost.select("value", "reason")) == [(" 01/01  01:00:00,9", "no header")]


def test_many_headers_without_places(spark):
    from zonarium.operators.reshape import MANY_HEADERS, parsed_cells, split_output_lines

    data = [("f", "Date/Time,ZA:x"), ("f", " 01/01  01:00:00,1"), ("f", "Date/Time,ZB:x"), ("g", "Date/Time,ZA:x"), ("g", "Date/Time,ZA:x"), ("g", " 01/01  01:00:00,2")]
    headers, body = split_output_lines(spark.createDataFrame(data, "file string, value string"))
    headers = files.with_file_names(headers.withColumn("file", F.concat(F.lit("/r/TimeSeriesData/Zone_"), "file", F.lit(".csv"))))
    body = body.withColumn("file", F.concat(F.lit("/r/TimeSeriesData/Zone_"), "file", F.lit(".csv")))
    wanted = jobs.wanted_columns(headers, spark.createDataFrame([("r", 1)], "run string, buildingid long"))
    cells = parsed_cells(body, headers, wanted, 2012)
    assert rows(cells.select("zonename", "value", "reason")) == sorted([(None, None, MANY_HEADERS), ("ZA", 2.0, None)], key=repr)


def scans(df):
    text = io.StringIO()
    with redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def test_no_fact_is_read_where_all_series_are_completed(spark):
    ledger = spark.createDataFrame([(1, "V", "Z", "Upload Completed", None, 7, 1)], LEDGER)
    keys = ledger.select("buildingid", "variablename", "subvariable")

    def facts(_):
        raise AssertionError("facts are read")

    state = loading.series_state(keys, ledger, facts)
    assert rows(state.select("subvariable", "n_rows")) == [("Z", 7)]


def test_a_second_load_counts_on(spark, tmp_path):
    root, file = str(tmp_path / "t"), tmp_path / RUN / "TimeSeriesData" / "Zone_Air.csv"
    for mode, hours in ((jobs.DEDUPE, range(1, 5)), (jobs.DEDUPE, range(1, 9)), (jobs.WATERMARK, range(1, 11))):
        write(file, [("ZA", hours)])
        facts = load(spark, root, f"{tmp_path}/*/TimeSeriesData/*.csv", mode, skip_completed=False)
        ledger = tables.read_table(spark, root, "ledger").first()
        assert ledger.n_rows == facts.count() and ledger.last_datetime == facts.agg(F.max("datetime")).first()[0]
    # By time only rows after the last one are taken: the 27th, hours 9 and 10.
    assert facts.count() == 27 * 8 + 2


def test_the_lines_are_read_twice_and_new_series_compare_with_nothing(spark, tmp_path, monkeypatch):
    pattern = f"{tmp_path}/*/TimeSeriesData/*.csv"
    write(tmp_path / RUN / "TimeSeriesData" / "Zone_Air.csv", [("ZA", range(1, 5))])
    monkeypatch.setattr(jobs, "new_rows", lambda *_: (_ for _ in ()).throw(AssertionError("facts are compared")))
    runs, read = [], spark.sparkContext.accumulator(0)
    lines = files.read_output_lines(spark, pattern)
    counted = F.udf(lambda v: (read.add(1), v)[1], "string").asNondeterministic()  # tests only
    lines = lines.withColumn("value", counted("value"))
    tables.ensure_tables(spark, str(tmp_path / "t"))
    runs = spark.createDataFrame([(RUN, 4)], "run string, buildingid long")
    jobs.load_outputs(spark, str(tmp_path / "t"), lines, runs, 2012, 60)
    assert read.value == 2 * (2 + 27 * 4)
    assert "Scan parquet" in scans(tables.read_table(spark, str(tmp_path / "t"), "timeseriesdata"))


def test_load_all_without_results_reports_or_models(spark, tmp_path):
    root, manifest, results = str(tmp_path / "t"), str(tmp_path / "m"), tmp_path / "results"
    entries = [("NA", "/models/a.idf", "w", str(results / r), "Not Started") for r in (RUN, "MS_ElPaso_3B_X_gas")]
    files.write_manifest(spark.createDataFrame(entries, MANIFEST), manifest)

    def states():
        jobs.load_all(spark, root, manifest, str(results), str(tmp_path / "models"), 2012, 60)
        return dict(files.read_manifest(spark, manifest).select(F.element_at(F.split("Completed Simulation FolderPath", "/"), -1), "Simulation Status").collect())

    assert not any_path(spark, str(results))
    assert set(states().values()) == {"Incomplete"}
    write(results / RUN / "TimeSeriesData" / "Zone_Air.csv", [("ZA", range(1, 5))])
    # The file's first line stands before its header: it is kept aside, and its building is not known.
    assert states() == {RUN: "Complete", "MS_ElPaso_3B_X_gas": "Incomplete"}
    assert states() == {RUN: "Complete", "MS_ElPaso_3B_X_gas": "Incomplete"}
    assert tables.read_table(spark, root, "timeseriesdata").count() == 27 * 4


def test_only_models_of_the_runs_are_read(spark, tmp_path):
    for name in "ab":
        (tmp_path / f"{name}.idf").write_text("ALL OBJECTS IN CLASS: COIL:HEATING:GAS\n")
    got = files.model_heating(spark, str(tmp_path), "{b.idf}").select(F.element_at(F.split("file", "/"), -1), "heating")
    assert rows(got) == [("b.idf", "Gas")]
    assert files.model_heating(spark, str(tmp_path / "none")).count() == 0
