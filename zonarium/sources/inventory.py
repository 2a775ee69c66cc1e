"""Which files a load has read: their paths, sizes and times of change.

A load compares the files that are there with those that earlier loads have
read to the end, and reads only new or changed ones.  An entry tells how
thorough the load was: whether it took late rows (``late``) and series that the
ledger calls completed (``completed``), and its settings.  A file counts as read
for loads that are no more thorough than one that has read it.

Entries are only added, and only after what they stand for is stored; a load
that broke off reads its files again.
"""

from pyspark.sql import functions as F

from ..operators.joins import lookup_join
from ..session import checkpointed
from .folders import any_path, remove_folder

OUTPUTS, REPORTS, MODELS = "outputs", "reports", "models"
STATE = ["file", "size", "changed"]
ENTRY = "file string, size long, changed timestamp, late boolean, completed boolean, settings string"

# Files are named in the scan's filter up to this many, so that others are not opened.
MAX_LISTED_FILES = 5_000


def files_found(spark, path, names=None):
    """``file``, ``size`` and ``changed`` of the files of a path or pattern; none if there are none.

    The content is not read.  ``file`` is written as the scans write it.  With a
    pattern of file ``names`` the folders below ``path`` are searched too.
    """
    if not any_path(spark, path):
        return spark.createDataFrame([], ENTRY).select(*STATE)
    reader = spark.read.format("binaryFile")
    if names:
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", names)
    return reader.load(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("changed"),
    )


def _path(root, kind):
    return f"{root.rstrip('/')}/files_read/{kind}"


def entries(spark, root, kind):
    path = _path(root, kind)
    return spark.read.schema(ENTRY).parquet(path) if any_path(spark, path) else spark.createDataFrame([], ENTRY)


def files_to_read(spark, root, kind, found, late=True, completed=True, settings=""):
    """Files of ``found`` that no load that is as thorough has read as they are; stored once."""
    read = entries(spark, root, kind).filter(F.col("settings") == settings)
    if late:
        read = read.filter("late")
    if completed:
        read = read.filter("completed")
    # A file may stand there once for each of its states, and for several loads.
    return checkpointed(lookup_join(found, read.select(*STATE).distinct(), STATE, "left_anti"))


def lines_of(read, spark, path, files):
    """Lines that ``read`` finds in some files; if these are not too many to be named, others are not opened."""
    names = [r.file for r in files.select("file").limit(MAX_LISTED_FILES + 1).collect()]
    if len(names) <= MAX_LISTED_FILES:
        return read(spark, path, names)
    return lookup_join(read(spark, path), files.select("file"), "file", "left_semi")


def note_files(files, root, kind, late=True, completed=True, settings=""):
    """Enter files that were read; what they hold has to be stored before."""
    marks = {"late": F.lit(late), "completed": F.lit(completed), "settings": F.lit(settings)}
    files.select(*STATE).withColumns(marks).write.mode("append").parquet(_path(root, kind))


def forget_files(spark, root, kind):
    """Let the next load read all files again."""
    remove_folder(spark, _path(root, kind))
