"""The incremental detail load as a file stream: new files are found by the stream's own log."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from curbline.contracts import MONTH_FILE_PATTERN
from curbline.operators.clean import clean_detail
from curbline.plans.incremental import merge_into_detail
from curbline.sources.files import cast_losses, layouts, month_path_pattern, read_raw, refuse_losses

LISTED = "path string, modificationTime timestamp, length bigint, content binary"


def start_detail_stream(
    spark: SparkSession,
    raw_dir: str,
    schema: T.StructType,
    detail_path: str,
    checkpoint: str,
    files_per_batch: int = 1000,
    pattern: str = MONTH_FILE_PATTERN,
    allow_losses: bool = False,
) -> StreamingQuery:
    """Merge every month file not seen before into the detail table, then stop; other names are ignored.

    The stream carries file names only; each batch reads its files as the batch
    load does, so types may differ and undeclared columns are kept. A batch
    repeated after a failure merges to the same distinct rows. Unlike the month
    rule, this also picks up a file delivered again under a new name. A batch with
    values that the declared types cannot hold fails before it writes, unless ``allow_losses``.
    """
    names = (
        spark.readStream.format("binaryFile")
        .schema(LISTED)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(raw_dir)
        .select("path")
        .where(F.col("path").rlike(month_path_pattern(spark, raw_dir, pattern)))
    )

    def merge(batch, _):
        paths = sorted(row["path"] for row in batch.collect())
        if paths:
            found = layouts(batch.sparkSession, paths)
            if not allow_losses:
                refuse_losses(cast_losses(batch.sparkSession, paths, schema, pattern, found))
            raw = read_raw(batch.sparkSession, paths, schema, found=found)
            merge_into_detail(batch.sparkSession, clean_detail(raw), detail_path)

    return (
        names.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
