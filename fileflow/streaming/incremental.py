"""T1 incremental file ingest with Structured Streaming.

A ``binaryFile`` file stream over the source folder delivers each new file once (the
checkpoint remembers which paths were seen). Every micro-batch runs the batch reader on just
its files and upserts the rows into the target snapshot table on the natural keys, so a
replayed micro-batch (at-least-once delivery after a failure) has no extra effect. With
``trigger(availableNow=True)`` a scheduled run processes everything new and stops.

Spark's file source does not deliver a file again that was rewritten under its path.
``changed=True`` reads with ``streaming.changes`` instead, which does, and which reads large files
in chunks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fileflow.functions.paths import extension
from fileflow.operators.table import SnapshotTable
from fileflow.session import materialize
from fileflow.sources.chunks import CHUNK_BYTES, reassembled
from fileflow.sources.discover import EXCEL_EXTENSIONS, SUPPORTED_EXTENSIONS
from fileflow.sources.dispatch import read_files
from fileflow.sources.profile import with_profile
from fileflow.streaming.changes import read_changes, settled

#: Files of one micro-batch, so that a backlog is worked off in bounded steps.
MAX_FILES_PER_TRIGGER = 10_000
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def ingest_stream(spark: SparkSession, source_root: str, table: SnapshotTable,
                  checkpoint: str, natural_keys: list[str] | None = None,
                  date_columns: list[str] | tuple[str, ...] = (), available_now: bool = True,
                  max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER,
                  changed: bool = False, chunk_bytes: int = CHUNK_BYTES) -> StreamingQuery:
    """``changed``: rewritten files too; their listings are kept beside the checkpoint."""
    def load(session: SparkSession, files: DataFrame | None, chunks: DataFrame | None) -> None:
        res = read_files(session, files, chunks=chunks, root=source_root,
                         date_columns=date_columns)
        data = materialize(res.data, "stream-rows")
        keys = natural_keys or ["source_file", "row_id"]
        table.upsert(data, keys,
                     order_by=[c for c in ("source_file", "row_id") if c in data.columns])

    if changed:
        def changes(chunks: DataFrame, epoch_id: int) -> None:
            rows = materialize(settled(materialize(chunks.filter(extension("path").isin(
                SUPPORTED_EXTENSIONS)), "stream-chunks")), "stream-batch")
            if rows.isEmpty():
                return
            books = extension("path").isin(EXCEL_EXTENSIONS)
            load(rows.sparkSession, reassembled(rows.filter(books)), rows.filter(~books))

        stream = read_changes(spark, source_root, f"{checkpoint.rstrip('/')}-listings",
                              chunk_bytes)
        return _start(stream.writeStream.foreachBatch(changes), checkpoint, available_now)
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA) \
        .option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(source_root)

    def batch(files: DataFrame, epoch_id: int) -> None:
        # the batch's bytes and profiles are written once; later steps read that copy
        ok = materialize(with_profile(files.filter(extension("path").isin(SUPPORTED_EXTENSIONS))
                                      .select("path", "content")), "stream-batch")
        if ok.isEmpty():
            return
        load(files.sparkSession, ok, None)

    return _start(stream.writeStream.foreachBatch(batch), checkpoint, available_now)


def _start(writer, checkpoint: str, available_now: bool) -> StreamingQuery:
    w = writer.option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def run_available(spark: SparkSession, source_root: str, table: SnapshotTable, checkpoint: str,
                  **kw) -> None:
    """Process every file not seen before, then return."""
    q = ingest_stream(spark, source_root, table, checkpoint, available_now=True, **kw)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
