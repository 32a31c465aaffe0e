"""Files as rows of bounded size (S3, S10): (path, size_bytes, modified_at, offset, content).

A ``binaryFile`` row holds a whole file, so it ends at 2 GB and puts a file into one task. Here no
row holds more than a chunk and every chunk is a task's unit of work:

* ``read_chunks``: a Python data source lists a folder and reads byte ranges, one or more per task,
  through the file system that the URI names. Nothing is read to plan it but the listing.
* ``chunked``: rows that already carry whole contents, cut into the same shape.

``digests`` gives each file's md5 (one pass over its chunks in order, a chunk at a time in memory)
and a tree digest: SHA-256 of every chunk, then of each FANOUT digests in a row, up to one. The
tree is computed by all tasks at once, and two versions of a file share the digests of the parts
that are alike.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from fileflow.session import materialize

CHUNK_BYTES = 32 << 20
#: Chunks are packed into one task up to this size. Its rows are parsed by one task too, here and
#: from what it writes, and short rows cost far more than their bytes.
TASK_BYTES = 16 << 20
FANOUT = 1024
CHUNKS = "path string, size_bytes long, modified_at timestamp, offset long, content binary"
_ARROW = pa.schema([("path", pa.string()), ("size_bytes", pa.int64()),
                    ("modified_at", pa.timestamp("us", "UTC")), ("offset", pa.int64()),
                    ("content", pa.binary())])


def open_fs(uri: str):
    """(file system, path on it) for a URI or a plain local path."""
    from pyarrow import fs
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), unquote(urlparse(uri).path)
    return fs.FileSystem.from_uri(uri)


def list_files(uri: str) -> list:
    """Files under a folder, or the file itself, in path order; hidden ones are left out, as by
    Spark's own readers. The listing holds names and sizes, no data."""
    from pyarrow import fs
    system, root = open_fs(uri)
    info = system.get_file_info([root])[0]
    if info.type == fs.FileType.NotFound:
        return []
    if info.type == fs.FileType.File:
        return [info]
    found = system.get_file_info(fs.FileSelector(root, recursive=True))
    return sorted((f for f in found if f.type == fs.FileType.File and not any(
        p[:1] in "_." for p in f.path[len(root.rstrip("/")):].strip("/").split("/"))),
        key=lambda f: f.path)


def shown(uri: str, path: str) -> str:
    """The path as Spark shows it: with the scheme (and host) of the URI it was asked by."""
    u = urlparse(uri)
    return f"{u.scheme}://{u.netloc}{path}" if "://" in uri and u.scheme != "file" \
        else f"file:{path}"


class Ranges(InputPartition):
    def __init__(self, ranges: list[tuple]):
        self.ranges = ranges          # (path, size, modified, offset, length)


def deal(files: list[tuple], chunk: int) -> list[Ranges]:
    """Byte ranges of (path, size, modified) files, packed into tasks."""
    out, task, held = [], [], 0
    for path, size, modified in files:
        for at in range(0, size, chunk):
            n = min(chunk, size - at)
            if task and held + n > max(TASK_BYTES, chunk):
                out.append(Ranges(task))
                task, held = [], 0
            task.append((path, size, modified, at, n))
            held += n
    return out + [Ranges(task)] if task else out


def chunk_row(*values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(values, _ARROW.types)],
                                      schema=_ARROW)


def reassembled(chunks: DataFrame) -> DataFrame:
    """(path, content) of files that fit a row."""
    return chunks.groupBy("path").agg(F.sort_array(F.collect_list(F.struct("offset", "content")))
                                      .alias("parts")).select("path", F.aggregate(
        "parts", F.lit(b""), lambda acc, x: F.concat(acc, x["content"])).alias("content"))


class ChunkReader(DataSourceReader):
    def __init__(self, options: dict):
        self.uri = options["path"]
        self.chunk = int(options.get("chunkBytes", CHUNK_BYTES))
        self.least = int(options.get("minBytes", 0))
        if self.chunk < 16:
            raise ValueError("chunkBytes must be 16 or more")

    def partitions(self) -> list[Ranges]:
        return deal([(f.path, f.size, f.mtime_ns // 1000) for f in list_files(self.uri)
                     if f.size > self.least], self.chunk) or [Ranges([])]

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        system, _ = open_fs(self.uri)
        for path, size, modified, at, n in partition.ranges:
            with system.open_input_file(path) as fh:
                data = fh.read_at(n, at)
            if len(data) != n:
                raise OSError(f"{path} changed while it was read")
            yield chunk_row(shown(self.uri, path), size, modified, at, data)


class ChunkSource(DataSource):
    """``spark.read.format("fileflow_chunks").option("chunkBytes", n).load(folder)``; with
    ``minBytes`` only files larger than that."""

    @classmethod
    def name(cls) -> str:
        return "fileflow_chunks"

    def schema(self) -> str:
        return CHUNKS

    def reader(self, schema) -> ChunkReader:
        return ChunkReader(self.options)


def read_chunks(spark: SparkSession, path: str, chunk_bytes: int = CHUNK_BYTES,
                min_bytes: int = 0) -> DataFrame:
    spark.dataSource.register(ChunkSource)
    return spark.read.format("fileflow_chunks").option("chunkBytes", str(chunk_bytes)) \
        .option("minBytes", str(min_bytes)).load(path)


def chunked(files: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Rows of whole contents (``path``, ``content``) as chunk rows; an empty file gives none."""
    size = F.octet_length("content").cast("long")
    starts = F.sequence(F.lit(0).cast("long"), size - 1, F.lit(chunk_bytes).cast("long"))
    return files.where(size > 0).select("path", size.alias("size_bytes"), "content",
                                        F.explode(starts).alias("offset")) \
        .select("path", "size_bytes", F.lit(None).cast("timestamp").alias("modified_at"), "offset",
                F.substring("content", (F.col("offset") + 1).cast("int"), F.lit(chunk_bytes))
                .alias("content"))


def _md5(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, checksum_md5) from chunks sorted by path and offset."""
    path, state, end = None, None, 0

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([state.hexdigest()])],
                                          ["path", "checksum_md5"])

    for b in batches:
        for i in range(b.num_rows):
            name, at, data = b.column(0)[i].as_py(), b.column(1)[i].as_py(), b.column(2)[i]
            if name != path:
                if state is not None:
                    yield done()
                path, state, end = name, hashlib.md5(), 0
            if at != end:
                raise ValueError(f"{name}: bytes {end} to {at} are missing or repeated")
            state.update(data.as_buffer())
            end = at + len(data.as_buffer())
    if state is not None:
        yield done()


def md5s(chunks: DataFrame) -> DataFrame:
    """(path, checksum_md5): equal to md5 of the whole content. md5 has no shorter way than one
    pass in order, so a file's chunks meet in one task, which holds one batch of them."""
    return (chunks.select("path", "offset", "content").repartition("path")
            .sortWithinPartitions("path", "offset")
            .mapInArrow(_md5, "path string, checksum_md5 string"))


def tree_digests(chunks: DataFrame) -> DataFrame:
    """(path, n_chunks, digest): the root over SHA-256 of the chunks, FANOUT to a node."""
    nodes = materialize(chunks.select("path", "offset", F.sha2("content", 256).alias("digest")),
                        "chunk-digests")
    sizes = nodes.groupBy("path").agg(F.count("*").alias("n_chunks"),
                                      F.min(F.when(F.col("offset") > 0, F.col("offset")))
                                      .alias("step"))
    nodes = nodes.join(sizes, "path").select(
        "path", "n_chunks", F.col("n_chunks").alias("n"), "digest",
        F.coalesce(F.floor(F.col("offset") / F.col("step")), F.lit(0)).alias("i"))
    most = sizes.agg(F.max("n_chunks")).first()[0] or 0
    while most > 1:                       # a level for each factor FANOUT of the largest file
        below = F.transform(F.sort_array(F.collect_list(F.struct("i", "digest"))),
                            lambda x: x["digest"])
        nodes = nodes.groupBy("path", "n_chunks", "n", F.floor(F.col("i") / FANOUT).alias("i")) \
            .agg(below.alias("below")) \
            .select("path", "n_chunks", F.ceil(F.col("n") / FANOUT).alias("n"), "i",
                    F.when(F.col("n") == 1, F.col("below")[0])
                    .otherwise(F.sha2(F.array_join("below", ""), 256)).alias("digest"))
        most = -(-most // FANOUT)
    return nodes.select("path", "digest", "n_chunks")


def digests(chunks: DataFrame) -> DataFrame:
    """(path, size_bytes, n_chunks, checksum_md5, digest) of every file."""
    sizes = chunks.groupBy("path").agg(F.max("size_bytes").alias("size_bytes"))
    return sizes.join(md5s(chunks), "path").join(tree_digests(chunks), "path")
