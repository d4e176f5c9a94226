"""Collecting with the file stream source instead of a listing and an anti-join."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.ingest import LISTING_SCHEMA, copy_files, new_files, read_ledger, settled
from ..sources.spec import SourceSpec

BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def collect_stream(
    spark: SparkSession,
    spec: SourceSpec,
    source: str,
    landing: str,
    checkpoint: str,
    files_per_batch: int = 10_000,
) -> StreamingQuery:
    """Copy every file not seen before, then stop (``availableNow``).

    The stream only tells which files are new; they are landed by ``copy_files`` like those of
    a listing, with all the fields found in them, in whatever format they come: files of other
    types are entered as rejected, and broken ones as quarantined. The checkpoint remembers the files; a file
    republished under the same path, or mended, is not read again by the stream (a listing, or a new
    checkpoint, finds quarantined files). A micro-batch that is replayed after a
    failure overwrites its own batch folder, or finds its files in the ledger and does nothing,
    so the landing zone holds each file once and is read by the same ``read_landing`` as the
    other collector's.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(source)
    )

    def land(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        # The query id lives in the checkpoint: a new checkpoint cannot reuse old folders.
        query_id = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        batch_id = f"stream-{query_id}-{epoch:08d}"
        # At most files_per_batch names; the contents are not read for them.
        paths = [unquote(row.path) for row in batch.collect()]
        listing = session.createDataFrame(
            [(spec.category, path.rsplit("/", 1)[-1], path) for path in paths], LISTING_SCHEMA
        )
        ledger = settled(read_ledger(session, landing, spec.category))
        fresh = new_files(listing, ledger, ["category", "file_name"]).collect()
        if fresh:
            found = [(row.file_name, row.path) for row in fresh]
            copy_files(session, spec, found, landing, batch_id)

    return (
        files.select(F.col("_metadata.file_path").alias("path"))
        .writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
