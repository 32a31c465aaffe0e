"""A stream of new and changed files (T1): a file rewritten in place is delivered again.

Spark's file stream knows a path as seen or not. This streaming data source compares listings: a
file is new or changed if its path, modification time and length are not all as in the last
listing. An offset is the number of a listing; the listings themselves are small files (one line
per file) in the folder ``log``, written once and never changed, so a batch that is run again after
a failure sees the same files. Listings older than the last finished batch are removed.

Rows are chunks (``sources.chunks``), so a large file is read by many tasks. A file that changes
between listing and reading gives incomplete rows or none: ``settled`` leaves it out, and the next
listing delivers it whole. A file that goes away is not reported.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader

from fileflow.session import materialize
from fileflow.sources.chunks import (CHUNK_BYTES, CHUNKS, Ranges, chunk_row, deal, list_files,
                                     open_fs, shown)
from fileflow.sources.landing import MAX_BROADCAST_FILES

_NAME = "listing-%09d.jsonl"


class ChangeReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.uri, self.log = options["path"], options["log"].rstrip("/")
        self.chunk = int(options.get("chunkBytes", CHUNK_BYTES))

    # -- listings ------------------------------------------------------------------------
    def _numbers(self) -> list[int]:
        from pyarrow import fs
        system, root = open_fs(self.log)
        found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
        names = [f.base_name for f in found]
        return sorted(int(x[8:17]) for x in names if x.startswith("listing-") and x[17:] == ".jsonl")

    def _listing(self, number: int) -> dict[str, tuple[int, int]]:
        """path -> (length, modification time); listing 0 is empty."""
        if not number:
            return {}
        system, root = open_fs(self.log)
        with system.open_input_stream(f"{root}/{_NAME % number}") as fh:
            rows = [json.loads(x) for x in fh.read().decode().splitlines()]
        return {path: (size, modified) for path, size, modified in rows}

    def initialOffset(self) -> dict:
        return {"listing": 0}

    def latestOffset(self) -> dict:
        last = max(self._numbers(), default=0)
        old = self._listing(last)
        now = {f.path: (f.size, f.mtime_ns // 1000) for f in list_files(self.uri)}
        if not set(now.items()) - set(old.items()):
            return {"listing": last}
        system, root = open_fs(self.log)
        system.create_dir(root, recursive=True)
        part = f"{root}/.{uuid.uuid4().hex}"
        with system.open_output_stream(part) as fh:
            for path, (size, modified) in sorted(now.items()):
                fh.write((json.dumps([path, size, modified]) + "\n").encode())
        system.move(part, f"{root}/{_NAME % (last + 1)}")
        return {"listing": last + 1}

    def commit(self, end: dict) -> None:
        system, root = open_fs(self.log)
        for n in self._numbers():
            if n < end["listing"]:
                system.delete_file(f"{root}/{_NAME % n}")

    # -- rows ----------------------------------------------------------------------------
    def partitions(self, start: dict, end: dict) -> list[Ranges]:
        old, new = self._listing(start["listing"]), self._listing(end["listing"])
        fresh = sorted((p, *x) for p, x in new.items() if old.get(p) != x)
        return deal(fresh, self.chunk)

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        system, _ = open_fs(self.uri)

        def as_listed(path, size, modified) -> bool:
            f = system.get_file_info([path])[0]
            return f.type == fs.FileType.File and (f.size, f.mtime_ns // 1000) == (size, modified)

        for path, size, modified, at, n in partition.ranges:
            if not as_listed(path, size, modified):
                continue
            with system.open_input_file(path) as fh:
                data = fh.read_at(n, at)
            if as_listed(path, size, modified):
                yield chunk_row(shown(self.uri, path), size, modified, at, data)


class ChangedFiles(DataSource):
    """``spark.readStream.format("fileflow_changes").option("log", folder).load(folder)``"""

    @classmethod
    def name(cls) -> str:
        return "fileflow_changes"

    def schema(self) -> str:
        return CHUNKS

    def streamReader(self, schema) -> ChangeReader:
        return ChangeReader(self.options)


def read_changes(spark: SparkSession, path: str, log: str,
                 chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    spark.dataSource.register(ChangedFiles)
    return spark.readStream.format("fileflow_changes").option("log", log) \
        .option("chunkBytes", str(chunk_bytes)).load(path)


def settled(chunks: DataFrame) -> DataFrame:
    """The chunks of files that are there from the first byte to the last."""
    whole = chunks.groupBy("path").agg(F.sum(F.octet_length("content")).alias("n"),
                                       F.max("size_bytes").alias("size")).where("n = size")
    # one short row per file: as a broadcast it leaves the chunks in the tasks that they are in
    whole = materialize(whole.select("path"), "stream-whole")
    return chunks.join(F.broadcast(whole) if whole.count() <= MAX_BROADCAST_FILES else whole,
                       "path", "left_semi")
