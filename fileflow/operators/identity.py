"""Dense 0..n-1 indexes without a single-task sort (W2 identities).

The input (sorted by ``order_by`` when given — a distributed range-partitioned sort, never
one task) is written once as Parquet under the shared checkpoint folder. Spark names each
output file after the task partition that wrote it (``part-<n>-...``), so partition order is
file order, and Parquet's ``_metadata.row_index`` is the position inside a file. A row count
per file (one row per file: size bounded by the file count, so broadcasting it is safe) and
its running sum give every file's offset: index = offset + row_index.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fileflow.session import scratch_path

BROADCAST_MAX_FILES = 1_000_000


def dense_index(df: DataFrame, name: str = "idx", start: int = 0,
                order_by: list[str] | None = None) -> DataFrame:
    """Add ``name`` = start, start+1, ... over ``df`` (in ``order_by`` order when given,
    else in the input's own order)."""
    spark = df.sparkSession
    src = df.orderBy(*order_by) if order_by else df   # names or Column sort orders
    path = scratch_path(spark, "dense-index")
    src.write.mode("overwrite").parquet(path)
    back = spark.read.parquet(path)
    part = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).cast("long")
    tagged = back.select("*", part.alias("_part"), F.col("_metadata.file_name").alias("_fname"),
                         F.col("_metadata.row_index").alias("_pos"))
    sizes = tagged.groupBy("_part", "_fname").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_part", "_fname").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0))) \
        .select("_fname", "_off")
    # one row per written file; check the file count before broadcasting it
    if len(back.inputFiles()) <= BROADCAST_MAX_FILES:
        offsets = F.broadcast(offsets)
    out = tagged.join(offsets, "_fname", "left") \
        .withColumn(name, (F.col("_off") + F.col("_pos") + F.lit(start)).cast("long"))
    return out.drop("_part", "_fname", "_pos", "_off")


def next_identity(current: DataFrame, col: str) -> int:
    """1 + max(id) of the current table, or 1 when empty (one scalar to the driver)."""
    m = current.agg(F.max(col)).first()[0]
    return 1 if m is None else int(m) + 1


def assign_identity(current: DataFrame, new_rows: DataFrame, col: str = "data_id",
                    order_by: list[str] | None = None) -> DataFrame:
    """Identity column on insert (W2): ids continue after the table's max, dense, in order."""
    start = next_identity(current, col) if col in current.columns else 1
    body = new_rows.drop(col) if col in new_rows.columns else new_rows
    return dense_index(body, col, start=start, order_by=order_by)
