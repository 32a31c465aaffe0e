"""Catalog tables with kept statistics (C1, C3, S20): counts and column figures without scans.

``register`` declares a table over a folder of Parquet files (``CREATE TABLE IF NOT EXISTS ...
USING parquet``), ``analyze`` has Spark compute its statistics once (``ANALYZE TABLE ... FOR ALL
COLUMNS``) and notes beside them when that was and what the folder held then: files, bytes and the
latest change. The listing and the statistics below come from the catalog and from folder listings
alone; no data file is opened. A table whose folder differs from what was noted is ``stale``, one
that was never analysed is ``none``; its figures are then of the past, or NULL.

Defined cases: an empty table has 0 rows, null rates of 0 and no bounds; columns of types that
Spark keeps no figures for (arrays, maps, structs, variants) have NULLs; bounds of text columns are
not kept (NULL); a name that is no table raises ``KeyError``. Statistics are kept as long as the
session catalog keeps the table (a Hive catalog: for good).
"""

from __future__ import annotations

import datetime as _dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

_NOTE = "analysed"
LISTING = "name string, row_count long, size_bytes long, last_analysed timestamp, status string"
COLUMNS = ("dataset string, column_name string, data_type string, row_count long, "
           "null_count long, null_rate double, distinct_count long, min_value string, "
           "max_value string, last_analysed timestamp, status string")


def _quoted(name: str) -> str:
    return ".".join(f"`{x.replace('`', '``')}`" for x in name.split("."))


def _text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register(spark: SparkSession, name: str, schema: StructType, path: str) -> bool:
    """Declare ``name`` over the Parquet files of ``path``; False if the table is there already."""
    if spark.catalog.tableExists(name):
        return False
    cols = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}"
                     for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_quoted(name)} ({cols}) USING parquet "
              f"LOCATION {_text(path)}")
    return True


def _kept(t: DataType) -> bool:
    return not isinstance(t, (StructType, ArrayType, MapType, VariantType))


def _described(spark: SparkSession, name: str) -> dict:
    """What the catalog holds of a table: its location, properties and statistics."""
    if not spark.catalog.tableExists(name):
        raise KeyError(f"Dataset '{name}' not found")
    return json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(name)} AS JSON").first()[0])


def _folder(spark: SparkSession, path: str) -> dict:
    """Files, bytes and latest change of a folder, by its listing."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(p, True)
    files = size = changed = 0
    while found.hasNext():
        f = found.next()
        files, size = files + 1, size + f.getLen()
        changed = max(changed, f.getModificationTime())
    return {"files": files, "bytes": size, "changed": changed}


def analyze(spark: SparkSession, name: str) -> None:
    """Compute and keep row count and column figures of a table."""
    before = _folder(spark, _described(spark, name)["location"])
    fields = spark.table(name).schema.fields
    # files added to the folder by others are seen by this session too
    spark.catalog.refreshTable(name)
    cols = ", ".join(f"`{f.name.replace('`', '``')}`" for f in fields if _kept(f.dataType))
    spark.sql(f"ANALYZE TABLE {_quoted(name)} COMPUTE STATISTICS"
              + (f" FOR COLUMNS {cols}" if cols else ""))
    at = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    note = _text(json.dumps(before | {"at": at.isoformat()}))
    spark.sql(f"ALTER TABLE {_quoted(name)} SET TBLPROPERTIES ('{_NOTE}' = {note})")


def _state(spark: SparkSession, name: str):
    """(row count, size, time of analysis, status, folder note) of one table, by the catalog."""
    held = _described(spark, name)
    now = _folder(spark, held["location"])
    note = json.loads(held.get("table_properties", {}).get(_NOTE, "null"))
    rows = held.get("statistics", {}).get("num_rows")
    if note is None or rows is None:
        return None, now["bytes"], None, "none"
    same = all(note[k] == v for k, v in now.items())
    return int(rows), now["bytes"], _dt.datetime.fromisoformat(note["at"]), \
        "fresh" if same else "stale"


def list_datasets(spark: SparkSession, names: list[str]) -> DataFrame:
    """One row per table (C1): row count as last analysed, size, time and status; by name."""
    rows = [(n, *_state(spark, n)) for n in sorted(names)]
    return spark.createDataFrame(rows, LISTING).orderBy("name")


def column_stats(spark: SparkSession, name: str) -> DataFrame:
    """One row per column (C3): nulls, distinct values (approximate) and bounds as last analysed."""
    count, _, at, status = _state(spark, name)
    rows = []
    for f in spark.table(name).schema.fields:
        got: dict[str, str] = {}
        if at is not None and _kept(f.dataType):
            col = f"`{f.name.replace('`', '``')}`"
            got = {r.info_name: r.info_value for r in spark.sql(
                f"DESCRIBE TABLE EXTENDED {_quoted(name)} {col}").collect()}
        figure = {k: None if v in (None, "NULL") else v for k, v in got.items()}
        nulls, distinct = (None if figure.get(k) is None else int(figure[k])
                           for k in ("num_nulls", "distinct_count"))
        rate = None if nulls is None else nulls / count if count else 0.0
        rows.append((name, f.name, f.dataType.simpleString(), count, nulls, rate, distinct,
                     figure.get("min"), figure.get("max"), at, status))
    return spark.createDataFrame(rows, COLUMNS)


def refresh(spark: SparkSession, names: list[str]) -> list[str]:
    """Analyse those tables again that are stale or were never analysed; their names."""
    due = [n for n in names if _state(spark, n)[3] != "fresh"]
    for n in due:
        analyze(spark, n)
    return due
