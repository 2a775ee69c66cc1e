import math

from pyspark.sql import functions as F

from helpers import rows
from zonarium.operators import reports
from zonarium.sources.files import read_eio, with_run_name, write_zone_info
from zonarium.schemas import EIO

TEXT = """Program Version Zone Information,invented
! <Zone Summary>,Number of Zones
 Zone Summary,2
! <Zone Information>,Zone Name,Old
! <Zone Information>,Zone Name,Floor Area {m2},Part of Total Building Area, 
 Zone Information,ZA,12.5,Yes, 
 Zone Information,ZB ,N/A
 Zone Information,ZC,1,2,3,4
! <People Internal Gains Nominal>,Name,Schedule Name,Zone Name,Number
 People Internal Gains Nominal,P1,S1, ZA,3
! <Lights Internal Gains Nominal>,Name,Zone Name
! <Zone Internal Gains Nominal>,Zone, Level
 Zone Internal Gains Nominal,ZA,4
 Unrelated,1,2
"""


def report(tmp_path, text=TEXT, run="R1"):
    folder = tmp_path / run / "OutputFiles"
    folder.mkdir(parents=True)
    (folder / "report.eio").write_text(text)
    return str(tmp_path / "*" / "OutputFiles" / "*.eio")


def test_read_eio_drops_the_first_line_of_each_file(spark, tmp_path):
    report(tmp_path, 'first,line\nsecond "line, with ,quote\n third,\n', "R1")
    path = report(tmp_path, "intro\nbody # x\n", "R 2+3")
    got = rows(with_run_name(read_eio(spark, path)).select("run", "value"))
    assert got == [("R 2+3", "body # x"), ("R1", " third,"), ("R1", 'second "line, with ,quote')]


def test_read_eio_in_small_splits(spark, tmp_path):
    body = "".join(f" Zone Information,Z{i},{i}\n" for i in range(500))
    path = report(tmp_path, "intro\n! <Zone Information>,Zone Name,Old\n" + body + "! <Zone Information>,Zone Name,New\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        lines = read_eio(spark, path)
        assert lines.rdd.getNumPartitions() > 3
        long = reports.sections_to_long(reports.pad_sections(reports.match_sections(lines)))
        assert rows(long.groupBy("variablename").count()) == [("New", 500)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_sections(spark, tmp_path):
    matched = reports.match_sections(read_eio(spark, report(tmp_path)))
    padded = reports.pad_sections(matched)
    got = {(r.tablename, tuple(r.header)): None for r in padded.collect()}
    assert set(got) == {
        ("Zone Information", ("Zone Name", "Floor Area {m2}", "Part of Total Building Area")),
        ("People Internal Gains Nominal", ("Name", "Schedule Name", "Zone Name", "Number")),
    }
    cells = rows(padded.select("tablename", "cells").withColumn("cells", F.concat_ws("|", "cells")))
    assert cells == [
        ("People Internal Gains Nominal", "P1|S1| ZA|3"),
        ("Zone Information", "ZA|12.5|Yes"),
        ("Zone Information", "ZB |N/A|NA"),
    ]
    bad = rows(reports.quarantined(matched).select("tablename", "reason"))
    assert bad == [
        ("Zone Information", "row longer than header"),
        ("Zone Internal Gains Nominal", "no zone column"),
    ]


def test_sections_to_long(spark, tmp_path):
    padded = reports.pad_sections(reports.match_sections(read_eio(spark, report(tmp_path))))
    got = rows(reports.sections_to_long(padded).drop("file"))
    assert got == sorted(
        [
            ("Zone Information", "ZA", "Floor Area {m2}", "NA", 12.5),
            ("Zone Information", "ZA", "Part of Total Building Area", "Yes", None),
            ("Zone Information", "ZB", "Floor Area {m2}", "N/A", None),
            ("Zone Information", "ZB", "Part of Total Building Area", "NA", None),
            ("People Internal Gains Nominal", "ZA", "Name", "P1", None),
            ("People Internal Gains Nominal", "ZA", "Schedule Name", "S1", None),
            ("People Internal Gains Nominal", "ZA", "Number", "NA", 3.0),
        ],
        key=repr,
    )


def test_a_data_line_goes_to_every_section_it_names(spark):
    text = [
        "! <Zone Information>,Zone Name,A",
        "! <People Internal Gains Nominal> Zone Information,Zone Name,B",
        " People Internal Gains Nominal,Z,Zone Information",
    ]
    lines = spark.createDataFrame([("f", i, t) for i, t in enumerate(text)], "file string, line_no int, value string")
    # the second comment line counts as a header of the first category it names
    got = rows(reports.match_sections(lines).select("tablename", F.concat_ws("|", "header")))
    assert got == [("Zone Information", "Zone Name|B")]
    lines = lines.unionByName(
        spark.createDataFrame([("f", 9, "! <People Internal Gains Nominal>,Zone Name,C")], lines.schema)
    )
    got = rows(reports.match_sections(lines).select("tablename", F.concat_ws("|", "header")))
    assert got == [
        ("People Internal Gains Nominal", "Zone Name|C"), ("Zone Information", "Zone Name|B"),
    ]


def test_new_report_rows(spark):
    def frame(data):
        return spark.createDataFrame([(None, *d) for d in data], EIO)

    batch = frame(
        [
            (1, "T", "Z", "V", "Yes", None),
            (1, "T", "Z", "V", "Yes", None),
            (1, "T", "Z", "W", "NA", 1.5),
            (1, "T", "Z", "W", "NA", 1.5),
            (1, "T", "Z", "X", "NA", math.nan),
        ]
    )
    existing = frame([(1, "T", "Z", "V", "Yes", None), (1, "T", "Z", "X", "NA", math.nan)])
    assert rows(reports.new_report_rows(batch, existing)) == [(1, "T", "Z", "W", "NA", 1.5)]


def zone_line(name, flag, width=31):
    cells = ["Zone Information", name] + ["0"] * (width - 2)
    if width > 29:
        cells[29] = flag
    return " " + ", ".join(cells).replace(", " + flag, "," + flag)


def test_zone_information(spark, tmp_path):
    text = "intro\n! <Zone Summary>,Number of Zones\n Zone Summary, 5\n" + "\n".join(
        [
            "! <Zone Information>,Zone Name",
            zone_line("A", "Yes"),
            zone_line("B", "No"),
            zone_line("C", "No"),
            zone_line("D", " No"),
            zone_line("E", "Yes", width=10),
        ]
    )
    path = report(tmp_path, text, "ASHRAE_2013_Buffalo_Hospital")
    lines = read_eio(spark, path)
    kept = reports.zone_information(reports.zone_table_rows(lines))
    assert sorted(r.cells[1] for r in kept.collect()) == ["A", "E"]
    assert rows(reports.zone_count_check(lines).select("announced", "found")) == [(5, 5)]

    out = str(tmp_path / "zones")
    write_zone_info(with_run_name(kept), out)
    back = spark.read.text(out)
    assert back.count() == 2
    assert [r[0] for r in back.select("buildingtype").distinct().collect()] == ["Hospital"]
