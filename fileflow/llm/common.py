"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fileflow.session import materialize, scratch_path

#: Rows and bytes of one Arrow batch handed to a Python worker (documents can be long).
BATCH_ROWS, BATCH_BYTES = 1000, "8m"
BROADCAST_IDS = 500_000       # rows that may be broadcast: 48 bytes each
ID_MAPS = 2048                # bitmaps of 4 KB each at most, of the ids that are too many for that


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small, so that a worker's memory does not grow with text length."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns that an operator is about to add (case-insensitive, like Spark's names)."""
    low = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in low])


def append_arrow(df: DataFrame, names_types: list[tuple[str, T.DataType]], fn) -> DataFrame:
    """Append columns computed per Arrow batch: ``fn(batch) -> list of arrays``.

    Input columns of the same names are replaced.
    """
    base = without(df, *[n for n, _ in names_types])
    schema = T.StructType(base.schema.fields + [T.StructField(n, t) for n, t in names_types])
    names = [n for n, _ in names_types]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new = fn(b)
            yield pa.RecordBatch.from_arrays(list(b.columns) + new, list(b.schema.names) + names)

    return base.mapInArrow(run, schema)


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a batch as one byte array and the n + 1 offsets into it (null: empty)."""
    col = col.fill_null("").cast(pa.large_binary())
    off = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0]:off[-1]], off - off[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (xor-shift multiply), element-wise."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def odd_constants(n: int, seed: int) -> np.ndarray:
    return mix64(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) | np.uint64(1)


def light(df: DataFrame) -> DataFrame:
    """``df`` (cheap to count), to be broadcast if it has few rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_IDS else df


def among(docs: DataFrame, on: str, ids: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows of ``docs`` that may have one of many ``ids``, rows that surely have none).

    A bitmap of the ids' hashes is broadcast, 32 bits an id but 8 MB at most, so that of the
    long rows only the first kind, few if few are wanted, has to meet the ids by a shuffle.
    """
    maps = min(ID_MAPS, ids.count() // 1024 + 1)

    def place(c: str) -> list:
        return [F.pmod(F.xxhash64(c), F.lit(maps)).alias("__map"),
                F.shiftrightunsigned(F.xxhash64(c), 49).alias("__at")]    # a bit of 32768

    bits = materialize(ids.select(*place(id_col)).repartition("__map").groupBy("__map").agg(
        F.bitmap_construct_agg("__at").alias("__bits")), "id-map")
    own = [F.col(f"`{c}`") for c in docs.columns]
    seen = docs.select(*own, *place(on)).join(F.broadcast(bits), "__map", "left")
    byte = F.conv(F.hex(F.expr("substring(__bits, cast(__at div 8 as int) + 1, 1)")), 16, 10)
    hit = F.getbit(byte.cast("int"), (F.col("__at") % 8).cast("int")) == 1
    hit = F.col(f"`{on}`").isNotNull() & F.coalesce(hit, F.lit(False))
    return seen.where(hit).select(*own), seen.where(~hit).select(*own)


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(id, component): the smallest id reachable over undirected links, for linked ids.

    Alternates large-star and small-star steps; every round is written to the shared folder
    and the plan restarts from it. Only (sum, count) of the edges come to the driver.
    """
    spark = links.sparkSession
    e = (links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
         .where("u != v").distinct())
    e = materialize(e, "cc")

    def state(x: DataFrame):
        r = x.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return tuple(r)

    last = state(e)
    for _ in range(max_rounds):
        if last[0] == 0:
            break
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.join(low, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct())
        large = materialize(large, "cc")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).where("u != v").distinct())
        e = materialize(small, "cc")
        now = state(e)
        if now == last:
            break
        last = now
    else:
        raise RuntimeError("components did not settle")
    out = e.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component"))
    return materialize(out.union(e.select(F.col("v").alias("id"), F.col("v").alias("component"))
                                 .distinct()), "cc")


__all__ = ["BATCH_ROWS", "BROADCAST_IDS", "among", "append_arrow", "components", "light",
           "materialize", "mix64", "odd_constants", "scratch_path", "small_batches", "table",
           "text_bytes", "without"]
