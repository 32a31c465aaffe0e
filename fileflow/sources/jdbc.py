"""Relational sinks and parameterised queries.

``bulk_insert`` appends to a snapshot table (Parquet) or, given a JDBC URL, through Spark's
JDBC writer in batches of ``batch_size`` rows. ``query`` runs SQL with named ``:markers`` bound
by Spark (never string-built), and lower-cases result column names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BATCH_SIZE = 10_000


def bulk_insert(df: DataFrame, target, table: str | None = None, batch_size: int = BATCH_SIZE,
                properties: dict | None = None) -> int:
    """Append ``df``; returns the number of rows written (0 for empty input)."""
    from fileflow.operators.table import SnapshotTable
    if isinstance(target, SnapshotTable):
        return target.append(df)
    if not isinstance(target, str) or not table:
        raise TypeError("target must be a SnapshotTable or a JDBC URL with a table name")
    from pyspark.sql import Observation
    from pyspark.sql import functions as F
    obs = Observation("bulk_insert")
    props = {"batchsize": str(batch_size), **(properties or {})}
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.jdbc(target, table, "append", props)
    return int(obs.get.get("rows", 0))


def query(spark: SparkSession, sql: str, params: dict | None = None, **frames) -> DataFrame:
    """``spark.sql`` with named parameters; columns lower-cased (S19). ``frames`` binds
    DataFrames to ``{name}`` placeholders."""
    df = spark.sql(sql, args=params or {}, **frames)
    return df.toDF(*[c.lower() for c in df.columns])


def read_table(spark: SparkSession, url: str, table: str, properties: dict | None = None,
               predicates: list[str] | None = None) -> DataFrame:
    """External table through JDBC; filters on the result are pushed to the database."""
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties or {})
