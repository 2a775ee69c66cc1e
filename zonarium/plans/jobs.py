"""Whole jobs: load runs, load reports, build the manifest and training sets."""

import re
import time

from pyspark.sql import functions as F

from ..functions.names import with_building_attributes
from ..functions.scalars import basename
from ..operators.aggregate import combined, modes_of, weighted_map
from ..operators.joins import lookup_join, plain_key
from ..operators.loading import (
    after_watermark,
    building_status,
    buildings_of,
    new_rows,
    not_loaded,
    of_buildings,
    of_variables,
    of_year,
    series_state,
    variables_of,
    with_subvariable,
)
from ..operators.manifest import (
    drop_broken_models,
    manifest_rows,
    match_weather,
    pending_runs,
    run_of_folder,
    update_manifest,
    with_run,
)
from ..operators.reports import (
    match_sections,
    new_report_rows,
    pad_sections,
    quarantined,
    section_headers,
    sections_to_long,
    without_header,
)
from ..operators.reshape import (
    collect_columns,
    good_rows,
    header_columns,
    parsed_cells,
    rejected_files,
    rejected_lines,
    split_output_lines,
)
from ..operators.retrieve import retrieve_rows
from ..schemas import (
    COMPLETE,
    INCOMPLETE,
    LEDGER_KEY,
    MANIFEST_KEY,
    NA,
    SUBVARIABLE_COLUMNS,
    UPLOAD_COMPLETED,
    UPLOAD_STARTED,
)
from ..session import checkpointed, written
from ..sources.files import (
    decoded,
    list_models,
    list_weather,
    model_heating,
    read_eio,
    read_manifest,
    read_output_lines,
    with_file_names,
    with_run_name,
    write_manifest,
)
from ..sources.inventory import MODELS, OUTPUTS, REPORTS, files_found, files_to_read, lines_of, note_files
from ..sources.tables import (
    add_buildings,
    add_rejected,
    append_rows,
    change_ledger,
    ensure_tables,
    read_table,
)

DEDUPE, WATERMARK = "dedupe", "watermark"


def wanted_columns(headers, runs, ledger=None):
    """Value columns to load per header: those of known runs, not completed yet.

    ``runs`` has ``run`` and ``buildingid``.
    """
    place = ["since"] if "since" in headers.columns else []
    headers = headers.withColumn("width", F.size("header"))
    columns = header_columns(lookup_join(headers, runs, "run", "inner"))
    if ledger is not None:
        columns = not_loaded(columns, ledger)
    return collect_columns(columns, ["file", *place, "buildingid", "variablename", "width"])


def load_outputs(
    spark, root, lines, runs, year, timeresolution, mode=DEDUPE, skip_completed=True
):
    """Load the output lines of any number of runs and variables in one plan.

    ``dedupe`` adds every row that is not stored; ``watermark`` adds the rows
    later than the last one loaded for their series.  Lines and cells that
    cannot be read go to ``timeseries_rejected`` with the reason, and their
    columns are not marked as completed; a file of an unknown run or kind of
    variable goes there by its header line.

    The lines are read twice, for the headers and for the cells.  The parsed
    cells are written to the shared folder; facts, rejected lines, last times
    and numbers of rows all come from there.  Facts are read only if some are
    stored for these buildings and variables.
    """
    if mode not in (DEDUPE, WATERMARK):
        raise ValueError(f"unknown load mode {mode!r}")
    started = time.monotonic()
    runs = checkpointed(runs)
    ledger = checkpointed(read_table(spark, root, "ledger"))
    headers, body = split_output_lines(lines)
    headers = checkpointed(with_file_names(headers))
    wanted = checkpointed(wanted_columns(headers, runs, ledger if skip_completed else None))
    keys = checkpointed(
        with_subvariable(
            wanted.select("buildingid", "variablename", F.inline("columns"))
        )
        .select(*LEDGER_KEY)
        .distinct()
    )
    begun = keys.withColumn("status", F.lit(UPLOAD_STARTED))
    change_ledger(begun, root)

    cells = written(parsed_cells(body, headers, wanted, year), "cells")
    batch = good_rows(cells, timeresolution).withColumn("value", F.col("value").cast("float"))

    def facts_of(some):
        """Facts of some series' buildings and variables: no others can equal or come before theirs."""
        buildings = buildings_of(some)
        facts = of_variables(read_table(spark, root, "timeseriesdata", buildings), variables_of(some))
        return of_buildings(facts, buildings)

    before = None
    if not facts_of(keys).isEmpty():
        before = checkpointed(series_state(keys, ledger, facts_of))
    if before is None:
        fresh = batch
    elif mode == DEDUPE:
        fresh = written(new_rows(batch, of_year(facts_of(keys), year)), "fresh")
    else:
        fresh = after_watermark(with_subvariable(batch), before).select(*batch.columns)
    # Counted before the append, as a series' marks are those of the time before.
    added = checkpointed(
        with_subvariable(fresh)
        .groupBy(*LEDGER_KEY)
        .agg(F.max("datetime").alias("added_last"), F.count(F.lit(1)).alias("added"))
    )
    append_rows(fresh, root, "timeseriesdata", keys)

    rejected = rejected_lines(cells).unionByName(rejected_files(headers, runs))
    add_rejected(rejected, root, "timeseries_rejected")
    unfit = (
        with_subvariable(cells.filter("reason IS NOT NULL AND buildingid IS NOT NULL"))
        .select(*LEDGER_KEY)
        .distinct()
        .withColumn("unfit", F.lit(True))
    )
    elapsed = int(time.monotonic() - started)
    done = keys.join(added, LEDGER_KEY, "left").join(unfit, LEDGER_KEY, "left")
    empty = spark.createDataFrame([], "buildingid long, variablename string, subvariable string, last_datetime timestamp_ntz, n_rows long")
    done = done.join(empty if before is None else before, LEDGER_KEY, "left").select(
        *LEDGER_KEY,
        F.when(F.col("unfit"), UPLOAD_STARTED).otherwise(UPLOAD_COMPLETED).alias("status"),
        F.greatest("last_datetime", "added_last").alias("last_datetime"),
        (F.coalesce("n_rows", F.lit(0)) + F.coalesce("added", F.lit(0))).alias("n_rows"),
        F.lit(elapsed).cast("long").alias("elapsed_seconds"),
    )
    change_ledger(done, root)


def load_variable(spark, root, path, buildingid, year, timeresolution, mode=WATERMARK):
    """Load the output file of one variable of one building."""
    lines = read_output_lines(spark, path)
    # The names come from the files that are there, not from each of their lines.
    files = with_file_names(files_found(spark, path).select("file"))
    runs = files.select("run", F.lit(buildingid).cast("long").alias("buildingid")).distinct()
    load_outputs(spark, root, lines, runs, year, timeresolution, mode)


def load_eio(spark, root, lines, runs):
    """Load the report lines of any number of runs.

    Rows that are longer than their header, or of a section without a header or
    a zone column, go to ``eio_rejected`` with the reason.
    """
    found = checkpointed(with_run_name(section_headers(lines)))
    headers = lookup_join(found, runs, "run", "inner").withColumn("file", plain_key("file"))
    headers = checkpointed(headers)
    matched = match_sections(lines, headers)
    batch = sections_to_long(pad_sections(matched), keys=("buildingid",))
    buildings = buildings_of(runs)
    stored = read_table(spark, root, "eiotabledata", buildings)
    append_rows(new_report_rows(batch, of_buildings(stored, buildings)), root, "eiotabledata", runs)
    headless = lookup_join(with_run_name(without_header(lines, found)), runs, "run", "inner")
    buildings = headers.select("file", "buildingid").distinct()
    rejected = lookup_join(quarantined(matched), buildings, "file", "inner").unionByName(headless.drop("run"))
    rejected = rejected.withColumn("value", F.concat_ws(",", "cells"))
    add_rejected(rejected, root, "eio_rejected")


def local_path(path):
    """Path without a ``file:`` scheme, as the manifest writes it."""
    return F.regexp_replace(path, "^file:/+", "/")


def register_buildings(spark, root, manifest, models_root):
    """Give every run of the manifest its building; returns ``run`` and ``buildingid``.

    Only the models that the manifest names are read, and of those only new or
    changed ones: a run whose building is stored keeps it while its model is as
    it was.
    """
    runs = checkpointed(
        manifest.select(
            local_path(F.col("IDF Filepath")).alias("IDF Filepath"),
            MANIFEST_KEY,
            F.col("BuildingID").try_cast("long").alias("buildingid"),
        ).dropDuplicates([MANIFEST_KEY])
    )
    names = runs.select(basename(F.col("IDF Filepath")).alias("name"))
    pattern = listed(names, "name")
    found = files_found(spark, models_root, pattern if pattern != "*" else "*.idf")
    models = files_to_read(spark, root, MODELS, found)
    changed = models.select(local_path(decoded(F.col("file"))).alias("IDF Filepath"))
    stored = read_table(spark, root, "buildingids").select("buildingid")
    kept = lookup_join(lookup_join(runs, stored, "buildingid", "left_semi"), changed, "IDF Filepath", "left_anti")
    kept = checkpointed(kept.select(run_of_folder().alias("run"), MANIFEST_KEY, "buildingid"))
    others = checkpointed(lookup_join(runs.drop("buildingid"), kept.select(MANIFEST_KEY), MANIFEST_KEY, "left_anti"))
    if others.isEmpty():
        return kept
    names = listed(others.select(basename(F.col("IDF Filepath")).alias("name")), "name")
    heating = model_heating(spark, models_root, names).select(
        local_path(F.col("file")).alias("IDF Filepath"), "heating"
    )
    described = with_building_attributes(
        lookup_join(others, heating, "IDF Filepath", "left"), MANIFEST_KEY, "heating"
    ).withColumn("run", run_of_folder())
    numbered = add_buildings(spark, described, root).select("run", MANIFEST_KEY, "buildingid")
    numbered = checkpointed(numbered)
    note_files(models, root, MODELS)
    return kept.unionByName(numbered)


# Run folders are named in the path up to this many.
MAX_LISTED_RUNS = 5_000


def listed(rows, column):
    """Path pattern of the names in a column; ``*`` if they are too many or cannot be written in one."""
    names = sorted({r[0] or "" for r in rows.select(column).distinct().limit(MAX_LISTED_RUNS + 1).collect()})
    plain = all(re.fullmatch(r"[\w .+=@-]+", name) for name in names)
    return "{" + ",".join(names) + "}" if names and plain and len(names) <= MAX_LISTED_RUNS else "*"


def run_folders(runs):
    """Path pattern of the runs' folders."""
    return listed(runs, "run")


def load_all(
    spark,
    root,
    manifest_path,
    results_root,
    models_root,
    year,
    timeresolution,
    mode=DEDUPE,
    with_reports=True,
    skip_completed=True,
):
    """Load all runs of the manifest that are not uploaded yet, in one plan.

    Buildings get their ids, series and reports are loaded, and the manifest
    is written back with ids and states.  Only the folders and models of those
    runs are looked at, and of their files only those are read that are new or changed
    since a load that was as thorough (see ``sources.inventory``); folders that are not there yet are no
    error, and a run without results stays ``Incomplete``.  A run whose state is ``Uploaded`` is never read again; this job
    leaves that state to its user and writes ``Complete``, as such a run may
    grow.  ``skip_completed=False`` takes the new lines of grown files.
    """
    ensure_tables(spark, root)
    manifest = checkpointed(read_manifest(spark, manifest_path))
    pending = pending_runs(manifest)
    if pending.isEmpty():
        return
    buildings = register_buildings(spark, root, pending, models_root)
    ids = buildings.select(MANIFEST_KEY, F.col("buildingid").cast("string").alias("value"))
    begun = buildings.select(MANIFEST_KEY, F.lit(INCOMPLETE).alias("value"))
    manifest = update_manifest(manifest, ids, "BuildingID")
    manifest = checkpointed(update_manifest(manifest, begun, "Simulation Status"))
    write_manifest(manifest, manifest_path)

    runs = buildings.select("run", "buildingid")
    folders = run_folders(runs)
    outputs = f"{results_root}/{folders}/TimeSeriesData/*.csv"
    thorough = {"late": mode == DEDUPE, "completed": not skip_completed, "settings": f"{year} {timeresolution}"}
    changed = files_to_read(spark, root, OUTPUTS, files_found(spark, outputs), **thorough)
    if not changed.isEmpty():
        lines = lines_of(read_output_lines, spark, outputs, changed)
        load_outputs(spark, root, lines, runs, year, timeresolution, mode, skip_completed)
        note_files(changed, root, OUTPUTS, **thorough)
    reports = f"{results_root}/{folders}/OutputFiles/*.eio"
    if with_reports:
        changed = files_to_read(spark, root, REPORTS, files_found(spark, reports))
        if not changed.isEmpty():
            load_eio(spark, root, lines_of(read_eio, spark, reports, changed), runs)
            note_files(changed, root, REPORTS)

    states = building_status(read_table(spark, root, "ledger")).filter(
        F.col("building_status") == COMPLETE
    )
    finished = buildings.join(states, "buildingid").select(
        MANIFEST_KEY, F.col("building_status").alias("value")
    )
    write_manifest(update_manifest(manifest, finished, "Simulation Status"), manifest_path)


def build_manifest(spark, data_root, results_root):
    """Manifest rows of all models and their weather files, broken models left out."""
    models = with_run(list_models(spark, data_root))
    matched = match_weather(models, list_weather(spark, data_root))
    return drop_broken_models(manifest_rows(matched, results_root))


def build_training_set(
    facts, zone_map, buildingid, start, end, zone, variables, how="mean", weights=None
):
    """One row per time for one aggregation zone, one column per variable.

    Series of the zone's members are aggregated; series that belong to no
    schedule, zone, surface or node are taken as they are (the largest value, if
    one has several at a time).  Both come from one conditional aggregate.  A
    variable of both kinds shows the zone's value where it has one.
    """
    rows = retrieve_rows(facts, buildingid, start, end)
    modes = modes_of([how], weights)
    members = zone_map.filter(F.col("aggregation_zone") == zone).withColumn("_member", F.lit(True))
    general = F.lit(True)
    for name in SUBVARIABLE_COLUMNS:
        general = general & (F.col(name) == NA)
    rows = lookup_join(
        rows.filter((F.col("zonename") != NA) | general),
        weighted_map(members, weights, modes).drop("aggregation_zone"),
        ["buildingid", "zonename"],
        "left",
        spread=["datetime"],
    ).filter(F.col("_member") | general)

    def column(variable):
        value = F.when(F.col("variablename") == variable, F.col("value").cast("double"))
        zonal = combined(how, F.when(F.col("_member"), value))
        return F.coalesce(zonal, F.max(F.when(general, value))).alias(variable)

    return rows.groupBy("buildingid", "datetime").agg(*[column(v) for v in variables])


__all__ = [
    "DEDUPE",
    "WATERMARK",
    "build_manifest",
    "build_training_set",
    "load_all",
    "load_eio",
    "load_outputs",
    "load_variable",
    "register_buildings",
    "wanted_columns",
]
