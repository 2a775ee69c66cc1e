"""The load job over output files as they arrive.

Each trigger takes the files that are new since the last one and runs the same
batch load on them, so a restart after a lost micro-batch adds no row twice.
"""

from pyspark.sql import functions as F

from ..plans.jobs import DEDUPE, load_outputs


def output_stream(spark, path, max_files=None):
    """Stream of output lines; a file is always taken whole."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )


def start_incremental_load(
    spark, root, path, runs, year, timeresolution, checkpoint, mode=DEDUPE, max_files=None
):
    """Load all files that arrived and stop; returns the streaming query."""

    def load(lines, _batch):
        # series may grow file by file, so completed ones are not skipped
        place = F.struct("block", F.monotonically_increasing_id().alias("row"))
        lines = lines.withColumn("line_no", place).drop("block")
        load_outputs(
            lines.sparkSession, root, lines, runs, year, timeresolution, mode, skip_completed=False
        )

    return (
        output_stream(spark, path, max_files)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
