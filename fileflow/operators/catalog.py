"""Catalog queries: list (C1, C4), describe (C2), statistics (C3 = A1 + A2 + A3)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def resolve(spark: SparkSession, name: str) -> DataFrame:
    """A dataset by name through the catalog (never by string-built SQL, survey Q21)."""
    if not spark.catalog.tableExists(name):
        raise KeyError(f"Dataset '{name}' not found")
    return spark.table(name)


def _tables(spark: SparkSession, tables: dict[str, DataFrame] | None) -> dict[str, DataFrame]:
    if tables is not None:
        return tables
    out = {}
    for t in spark.catalog.listTables():
        out[t.name] = spark.table(t.name)
    return out


def list_datasets(spark: SparkSession, tables: dict[str, DataFrame] | None = None,
                  time_col: str = "loaded_at") -> DataFrame:
    """One row per dataset: name, row_count (0 when empty), last_loaded; ordered by name.

    A single plan: each table contributes a one-row aggregate, the rows are unioned. Counts
    on Parquet read no column data.
    """
    parts = []
    for name, df in sorted(_tables(spark, tables).items()):
        has_time = time_col in df.columns
        last = F.max(time_col).cast("timestamp") if has_time else F.lit(None).cast("timestamp")
        parts.append(df.agg(F.count(F.lit(1)).alias("row_count"), last.alias("last_loaded"))
                     .select(F.lit(name).alias("name"),
                             F.coalesce("row_count", F.lit(0)).cast("long").alias("row_count"),
                             "last_loaded"))
    if not parts:
        return spark.createDataFrame([], "name string, row_count long, last_loaded timestamp")
    # identical shapes: a positional union avoids re-resolving columns by name per part
    return reduce(DataFrame.union, parts).orderBy("name")


def status_table(datasets: DataFrame) -> DataFrame:
    """Dataset status table for display."""
    return datasets.select(F.col("name").alias("Dataset"), F.col("row_count").alias("Row Count"),
                           F.col("last_loaded").alias("Last Loaded"))


def describe(df: DataFrame, name: str) -> DataFrame:
    """Lower-cased columns in schema order with the exact row count (C2), long form.

    The column list is a literal array exploded next to the one-row count: no join.
    """
    cols = F.array(*[F.struct(F.lit(i).alias("ordinal"), F.lit(c.lower()).alias("column_name"))
                     for i, c in enumerate(df.columns)])
    return df.agg(F.count(F.lit(1)).alias("row_count")) \
        .select(F.lit(name).alias("dataset"), F.inline(cols), "row_count")


def null_rates(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Null rate per column in one pass, long form (column, null_rate) (A3)."""
    cols = columns or df.columns
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, null_rate double")
    aggs = [F.avg(F.col(f"`{c}`").isNull().cast("double")).alias(f"r{i}")
            for i, c in enumerate(cols)]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c.replace(chr(39), chr(39) * 2)}', r{i}" for i, c in enumerate(cols))
    return wide.selectExpr(f"stack({len(cols)}, {stack}) as (column, null_rate)")


def stats(df: DataFrame, name: str, time_col: str = "loaded_at",
          with_null_rates: bool = True) -> DataFrame:
    """Dataset statistics in one aggregate pass (C3): count, null_rates map, min/max time."""
    aggs = [F.count(F.lit(1)).alias("row_count")]
    if time_col in df.columns:
        aggs += [F.min(time_col).alias("min_loaded_at"), F.max(time_col).alias("max_loaded_at")]
    else:
        aggs += [F.lit(None).cast("timestamp").alias("min_loaded_at"),
                 F.lit(None).cast("timestamp").alias("max_loaded_at")]
    if with_null_rates and df.columns:
        kv = []
        for c in df.columns:
            kv += [F.lit(c), F.avg(F.col(f"`{c}`").isNull().cast("double"))]
        aggs.append(F.create_map(*kv).alias("null_rates"))
    else:
        aggs.append(F.create_map().cast("map<string,double>").alias("null_rates"))
    return df.agg(*aggs).select(F.lit(name).alias("dataset"), "row_count", "null_rates",
                                "min_loaded_at", "max_loaded_at")
