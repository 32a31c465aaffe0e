"""Rank index for deep pages (L2, N1): rows stored once in order, offsets found by counts.

Layout under ``root``::

    root/_log/            one row per build (order, name of the source, rows, folder)
    root/<build>/data/    the rows in order, range by range
    root/<build>/ranges/  (file, first, rows, low): first rank, rows and lowest key of each file

A build is one range partitioning into tasks of about TASK_ROWS rows, a sort inside each and a new
file after every ``rows_per_range`` rows, so what the driver hears of (sampled keys, task results)
goes by the tasks and not by the ranges. The rows of a page at any offset
lie in the files whose ranks ``first .. first + rows - 1`` meet the page: only those are opened, and
inside them a row's rank is ``first`` plus its position in the file. So the cost of a page depends
on ``rows_per_range`` and not on the offset or on the size of the table.

The order is total: after ``order_by`` come all other columns that can be ordered; rows that are
equal in all of them are dealt by a random number, so copies of one row spread over ranges too.
NULLs come last, as in ``records.page``.

Defined cases: an empty table has no ranges and empty pages; an offset past the end gives an empty
page; a build that dies before its log row is never read; ``of_table`` names a build after the
table's version, so rows of an older version are never served.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from fileflow.operators.records import MAX_PAGE
from fileflow.session import path_exists

ROWS_PER_RANGE = 1_000_000
#: Rows of one task of a build: it writes many ranges where they are smaller.
TASK_ROWS = 500_000
_TIE = "__tie"
_LOG_SCHEMA = ("build string, source string, order_by array<string>, schema_json string, "
               "rows long, ranges long, built_at timestamp")
_RANGES_SCHEMA = "file string, first long, rows long, low string"


class RankIndex:
    """Pages of one build; made by ``build``, ``of_table`` or ``open_index``."""

    def __init__(self, spark: SparkSession, root: str, entry):
        self.spark, self.entry = spark, entry
        self.path = f"{root}/{entry.build}"
        self.rows, self.order_by = int(entry.rows), list(entry.order_by)

    def ranges(self) -> DataFrame:
        return self.spark.read.schema(_RANGES_SCHEMA).parquet(f"{self.path}/ranges")

    def _opened(self, offset: int, limit: int) -> list:
        """The ranges that hold ranks offset .. offset + limit - 1: at most ``limit`` rows."""
        last = F.col("first") + F.col("rows")
        return self.ranges().filter((F.col("first") < offset + limit) & (last > offset)) \
            .orderBy("first").collect()

    def page(self, limit: int = 100, offset: int = 0, with_rn: bool = False) -> DataFrame:
        """Rows ``offset`` .. ``offset + limit - 1`` of the order; ``rn`` counts from 1."""
        if not 1 <= limit <= MAX_PAGE:
            raise ValueError(f"limit must be within 1..{MAX_PAGE}")
        if offset < 0:
            raise ValueError("offset must be >= 0")
        schema = StructType.fromJson(json.loads(self.entry.schema_json))
        if with_rn and "rn" in schema.names:
            raise ValueError("the table has a column named rn")
        found = self._opened(offset, limit)
        out = schema.names + (["rn"] if with_rn else [])
        if not found:
            return self.spark.createDataFrame([], schema).withColumn(
                "rn", F.lit(None).cast("long")).select(*[F.col(f"`{c}`") for c in out])
        first = F.create_map(*[F.lit(x) for r in found for x in (r.file, r.first)])
        rows = self.spark.read.schema(schema).parquet(
            *[f"{self.path}/data/{r.file}" for r in found])
        rank = first[F.col("_metadata.file_name")] + F.col("_metadata.row_index")
        return rows.withColumn("rn", rank + 1) \
            .filter((F.col("rn") > offset) & (F.col("rn") <= offset + limit)) \
            .orderBy("rn").select(*[F.col(f"`{c}`") for c in out])

    def pages(self, limit: int) -> int:
        """How many pages of ``limit`` rows there are."""
        return -(-self.rows // limit)


def _sortable(t) -> bool:
    if isinstance(t, StructType):
        return all(_sortable(f.dataType) for f in t.fields)
    if isinstance(t, ArrayType):
        return _sortable(t.elementType)
    return not isinstance(t, (MapType, VariantType))


def build(df: DataFrame, root: str, order_by: list[str], source: str = "",
          rows_per_range: int = ROWS_PER_RANGE) -> RankIndex:
    """Store ``df`` in order under ``root`` and note where each range begins."""
    if not order_by or any(c not in df.columns for c in order_by):
        raise ValueError("order_by needs columns of the table")
    spark, root = df.sparkSession, root.rstrip("/")
    name = f"build-{uuid.uuid4().hex[:12]}"
    rest = [f.name for f in df.schema.fields if f.name not in order_by and _sortable(f.dataType)]
    order = [F.col(f"`{c}`").asc_nulls_last() for c in [*order_by, *rest]] + [F.col(_TIE).asc()]
    rows = df.count()
    n = max(1, -(-rows // max(rows_per_range, TASK_ROWS)),
            min(-(-rows // rows_per_range), spark.sparkContext.defaultParallelism))
    # a count of partitions given by number is not coalesced
    (df.withColumn(_TIE, F.rand(11)).repartitionByRange(n, *order).sortWithinPartitions(*order)
     .drop(_TIE).write.option("maxRecordsPerFile", str(rows_per_range))
     .parquet(f"{root}/{name}/data"))
    # a task numbers its files in the order it writes them
    part, seq = (F.regexp_extract("file", rx, 1).cast("long")
                 for rx in (r"^part-(\d+)", r"-c(\d+)\."))
    low = F.to_json(F.struct(*[F.col(f"`{c}`") for c in order_by]))
    files = (spark.read.schema(df.schema).parquet(f"{root}/{name}/data")
             .select(F.col("_metadata.file_name").alias("file"),
                     F.when(F.col("_metadata.row_index") == 0, low).alias("low"))
             .groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.max("low").alias("low"))
             .withColumn("part", part).withColumn("seq", seq))
    # running sum in two steps: over tasks, then over the files of each
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    parts = files.groupBy("part").agg(F.sum("rows").alias("in_part")).withColumn(
        "base", F.coalesce(F.sum("in_part").over(before.orderBy("part")), F.lit(0)))
    inside = F.coalesce(F.sum("rows").over(
        before.partitionBy("part").orderBy("seq", "file")), F.lit(0))
    (files.withColumn("inside", inside).join(parts.select("part", "base"), "part")
     .select("file", (F.col("base") + F.col("inside")).alias("first"), "rows", "low")
     .write.parquet(f"{root}/{name}/ranges"))
    total = spark.read.schema(_RANGES_SCHEMA).parquet(f"{root}/{name}/ranges").agg(
        F.coalesce(F.sum("rows"), F.lit(0)), F.count(F.lit(1))).first()
    spark.range(1).select(
        F.lit(name).alias("build"), F.lit(source).alias("source"),
        F.array(*[F.lit(c) for c in order_by]).alias("order_by"),
        F.lit(df.schema.json()).alias("schema_json"), F.lit(int(total[0])).cast("long").alias("rows"),
        F.lit(int(total[1])).cast("long").alias("ranges"),
        F.current_timestamp().alias("built_at")).write.mode("append").parquet(f"{root}/_log")
    return open_index(spark, root, order_by, source)


def open_index(spark: SparkSession, root: str, order_by: list[str], source: str = ""):
    """The latest build of this source and order, or None."""
    root = root.rstrip("/")
    if not path_exists(spark, f"{root}/_log"):
        return None
    wanted = F.array(*[F.lit(c) for c in order_by])
    got = spark.read.schema(_LOG_SCHEMA).parquet(f"{root}/_log").filter(
        (F.col("source") == source) & (F.col("order_by") == wanted)) \
        .orderBy(F.col("built_at").desc(), "build").limit(1).collect()
    return RankIndex(spark, root, got[0]) if got else None


def of_table(table, order_by: list[str], rows_per_range: int = ROWS_PER_RANGE) -> RankIndex:
    """The index of a snapshot table's current version; built once for each version and order."""
    root, source = f"{table.root}/_rank", f"v{table.version()}"
    found = open_index(table.spark, root, order_by, source)
    return found or build(table.read(), root, order_by, source, rows_per_range)
