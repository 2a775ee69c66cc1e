"""The manifest of simulation runs."""

from pyspark.sql import functions as F

from ..functions.names import COMMERCIAL, MANUFACTURED, RESIDENTIAL, is_broken_model, run_name
from ..functions.scalars import basename
from ..schemas import MANIFEST_COLUMNS, MANIFEST_KEY, NA, NOT_STARTED, UPLOADED
from ..session import checkpointed
from .joins import lookup_join

# Part of the run name that is the location, per kind of model.
LOCATION_PART = {COMMERCIAL: 2, MANUFACTURED: 1, RESIDENTIAL: 2}


def run_location(run, kind):
    """Location part of a run name; ``kind`` is a column of category names."""
    part = F.coalesce(*[F.when(kind == k, i) for k, i in LOCATION_PART.items()])
    return F.get(F.split(run, "_"), part)


def match_weather(models, weather, on_kind=True):
    """Each model with every weather file whose path contains its location.

    ``models`` has ``location`` (and ``kind``), ``weather`` has
    ``weather_path`` (and ``kind``).  Instead of testing all pairs, the distinct
    locations are keyed by their first letters, as many as the shortest of them
    has.  Each path gives its different grams of that one length, no more than
    it has letters; those are joined with the keys by equality and the whole
    location is tested after that.  Locations are plain words, so this equals a
    pattern search; an empty one is in every path.  Locations and pairs are
    small and used more than once, so each is stored.
    """
    on = ["kind"] if on_kind else []
    length = F.length("location")
    locations = checkpointed(models.select(*on, "location").filter(F.col("location").isNotNull()).distinct())
    n = locations.agg(F.min(F.when(length > 0, length))).first()[0] or 1
    keyed = locations.withColumn("_gram", F.substring("location", 1, n))
    path = F.col("weather_path")
    starts = F.sequence(F.lit(1), F.greatest(F.length(path) - n + 1, F.lit(1)))
    grams = F.transform(starts, lambda at: F.substring(path, at, F.lit(n)))
    grams = F.array_union(grams, F.array(F.lit("")))
    paths = weather.select(*on, "weather_path").distinct().withColumn("_gram", F.explode(grams))
    # A location has one key and a path each gram once, so a pair comes up once.
    pairs = lookup_join(paths, keyed, [*on, "_gram"], "inner").filter(F.contains(path, F.col("location")))
    return lookup_join(models, checkpointed(pairs.drop("_gram")), [*on, "location"], "inner")


def manifest_rows(matched, results_root):
    """New manifest rows of matched models: no building id, not started."""
    values = [
        F.lit(NA),
        F.col("model_path"),
        F.col("weather_path"),
        F.concat(F.lit(results_root.rstrip("/") + "/"), F.col("run_name")),
        F.lit(NOT_STARTED),
    ]
    return matched.select(*[v.alias(c) for v, c in zip(values, MANIFEST_COLUMNS)])


def with_run(models):
    """Models with their run name and location."""
    name = run_name(F.col("model_path"))
    return models.withColumn("run_name", name).withColumn(
        "location", run_location(F.col("run_name"), F.col("kind"))
    )


def drop_broken_models(manifest, column="IDF Filepath"):
    """Manifest without the models known not to run."""
    return manifest.filter(~is_broken_model(F.col(column)))


def manifest_field(field):
    """Manifest column of a field name; an unknown field is an error."""
    for column in MANIFEST_COLUMNS:
        if column.lower() == field.lower():
            return column
    raise KeyError(f"unknown manifest field {field!r}")


def update_manifest(manifest, updates, field):
    """Manifest with one field set for the runs in ``updates``.

    ``updates`` has the results folder and ``value``, one row per folder.  All
    manifest rows of a folder are set; folders not in the manifest change
    nothing.
    """
    column = manifest_field(field)
    new = updates.select(MANIFEST_KEY, F.col("value").alias("_value"))
    joined = lookup_join(manifest, new, MANIFEST_KEY, "left")
    return joined.select(
        *[
            F.coalesce("_value", F.col(c)).alias(c) if c == column else F.col(c)
            for c in manifest.columns
        ]
    )


def pending_runs(manifest):
    """Runs that are not uploaded yet; a run without a status is pending too."""
    return manifest.filter(~F.trim("Simulation Status").eqNullSafe(F.lit(UPLOADED)))


def has_building(manifest):
    """Runs that already have a building id."""
    return manifest.filter(F.col("BuildingID") != NA)


def run_of_folder(column=MANIFEST_KEY):
    """Run name of a results folder."""
    return basename(F.col(column))
