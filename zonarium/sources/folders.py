"""Folders that are replaced as a whole, so that a broken write loses nothing, and rows in folders by building."""

from pyspark.sql import functions as F

# Rows of up to this many buildings have a folder for each building.
MAX_BUILDING_FOLDERS = 128
# Rows of more are dealt to this many folders, so that their number does not grow with the buildings.
BUILDING_BUCKETS = 128
BUCKET = "building_bucket"


def _at(spark, path):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _path(spark, path):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def settle(spark, path):
    """Finish, or take back, a replacement of ``path`` that broke off.

    The old content stays until the new one is complete; then either of the
    two is found, and nothing in between.
    """
    fs, at = _at(spark, path)
    if fs.exists(at):
        return
    new, old = _path(spark, f"{path}.new"), _path(spark, f"{path}.old")
    if fs.exists(_path(spark, f"{path}.new/_SUCCESS")):
        fs.rename(new, at)
        fs.delete(old, True)
    elif fs.exists(old):
        fs.rename(old, at)


def replace_folder(spark, path, write, note=None):
    """Replace ``path`` by what ``write`` makes of the path it is given.

    A ``note`` is kept with the content, as the name of an empty file (see ``note_of``).
    """
    path = path.rstrip("/")
    settle(spark, path)
    fs, at = _at(spark, path)
    new, old = _path(spark, f"{path}.new"), _path(spark, f"{path}.old")
    fs.delete(new, True)
    write(f"{path}.new")
    if note is not None:
        fs.create(_path(spark, f"{path}.new/_note={note}")).close()
    fs.delete(old, True)
    if fs.exists(at):
        fs.rename(at, old)
    fs.rename(new, at)
    fs.delete(old, True)


def any_path(spark, pattern):
    """Whether a path, or a pattern of paths, names anything."""
    fs, at = _at(spark, pattern)
    return bool(fs.globStatus(at))


def note_of(spark, path):
    """The note that was kept with a replaced folder, or None."""
    fs, _ = _at(spark, path)
    found = fs.globStatus(_path(spark, f"{path.rstrip('/')}/_note=*"))
    return found[0].getPath().getName().partition("=")[2] if found else None


def folders_in(spark, path, prefix):
    """Names of the completely written folders in ``path`` that start with ``prefix``, sorted."""
    fs, _ = _at(spark, path)
    found = fs.globStatus(_path(spark, f"{path.rstrip('/')}/{prefix}*/_SUCCESS"))
    return sorted(f.getPath().getParent().getName() for f in found or ())


def remove_folder(spark, path):
    fs, at = _at(spark, path)
    fs.delete(at, True)


def size_of(spark, path):
    """Bytes of all files below ``path``."""
    fs, at = _at(spark, path)
    return fs.getContentSummary(at).getLength()


def many_buildings(rows):
    """Whether the rows are of more buildings than get a folder each."""
    return rows.select("buildingid").distinct().limit(MAX_BUILDING_FOLDERS + 1).count() > MAX_BUILDING_FOLDERS


def buckets_of(buildings):
    """Buckets of some building ids."""
    return sorted({b % BUILDING_BUCKETS for b in buildings if b is not None})


def write_by_building(rows, path, order, bucketed):
    """Write rows to a folder for each building or, ``bucketed``, for each bucket of buildings.

    They are rebalanced by folder, so a folder is written by few tasks while
    one that holds much of the rows is still split.  In a bucket the rows are sorted
    by building, so a reader of one building skips the pages of the others.
    """
    folder = BUCKET if bucketed else "buildingid"
    if bucketed:
        rows = rows.withColumn(BUCKET, F.pmod("buildingid", F.lit(BUILDING_BUCKETS)).cast("int"))
    (
        rows.hint("rebalance", folder)
        .sortWithinPartitions(*dict.fromkeys([folder, *order]))
        .write.mode("overwrite")
        .partitionBy(folder)
        .parquet(path)
    )
