"""Snapshot tables on plain Parquet: versions, atomic publish, create-if-absent.

Layout under ``root``::

    root/_log/                  one small Parquet file appended per commit
    root/data/_v=<attempt>/...  Parquet written by one attempt (plus any partition columns)

Every attempt to commit writes its data under a folder of its own (a random number), then
appends one log row ``(version, committed_at, operation, versions, schema_json, rows, inserted,
updated, partition_by)``. The current table is the data of the attempt folders listed in
``versions`` by the highest log row: an overwrite lists only its own, an append lists the
earlier ones plus its own.

A table made with ``buckets`` is split by a hash of its keys: an attempt writes
``_v=<attempt>/_b=<bucket>`` and the log row lists the live folders in ``folders``. An upsert reads
and rewrites only the buckets its source rows fall in, in a new attempt; the folders of the other
buckets are taken over as they are. Rows with a NULL key never match, so they are added as files of
their own (bucket -1). The hash is of the keys' text, so a key column that widens keeps its
buckets; where a column's type changes, all buckets are rewritten once.

A writer that dies before its log row leaves a folder that no row
names, so nothing of it is ever read; a version number that is already in the log is refused.
Only the live folders are listed by a read. The log is read anew by every call, so commits of
other processes are seen. One writer per table at a time is assumed, as with the reference's
single MERGE transaction; two that race are told apart by the refused version.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DataType, DateType, DecimalType, DoubleType, FloatType,
                               IntegerType, LongType, NullType, NumericType, ShortType,
                               StringType, StructType, TimestampType)

from fileflow.operators.lattice import number_type
from fileflow.session import folders, path_exists

_LOG_SCHEMA = ("version long, committed_at timestamp, operation string, versions array<long>, "
               "schema_json string, rows long, inserted long, updated long, "
               "partition_by array<string>, folders array<string>, buckets int, "
               "bucket_by array<string>")
#: Rows of a bucket that one task writes.
TASK_ROWS = 5_000_000
_BUCKET = "_b"


class SnapshotTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.log_path = f"{self.root}/_log"
        self.data_path = f"{self.root}/data"

    # -- metadata ------------------------------------------------------------------------
    def log(self) -> DataFrame:
        if not path_exists(self.spark, self.log_path):
            return self.spark.createDataFrame([], _LOG_SCHEMA)
        return self.spark.read.schema(_LOG_SCHEMA).parquet(self.log_path)

    def head(self, version: int | None = None):
        """The log row of ``version`` (default: latest), or None. One row reaches the driver."""
        lg = self.log()
        if version is not None:
            lg = lg.filter(F.col("version") == version)
        rows = lg.orderBy(F.col("version").desc()).limit(1).collect()
        return rows[0] if rows else None

    def exists(self) -> bool:
        return self.head() is not None

    def version(self) -> int:
        h = self.head()
        return int(h.version) if h else 0

    # -- reads ---------------------------------------------------------------------------
    def read(self, version: int | None = None) -> DataFrame:
        h = self.head(version)
        if h is None:
            raise FileNotFoundError(f"no table at {self.root}")
        return self._read(h)

    def _read(self, h) -> DataFrame:
        schema = StructType.fromJson(json.loads(h.schema_json))
        live = h.folders if h.buckets else [f"_v={v}" for v in h.versions]
        return self._files(schema, live if h.rows else [])

    def _files(self, schema: StructType, live: list[str]) -> DataFrame:
        if not live:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.data_path) \
            .parquet(*[f"{self.data_path}/{x}" for x in live]) \
            .select(*[F.col(f"`{c}`") for c in schema.fieldNames()])

    # -- writes --------------------------------------------------------------------------
    def _write(self, df: DataFrame, partition_by: list[str] | None):
        """Write one attempt; (its folder number, rows)."""
        attempt = uuid.uuid4().int >> 66
        obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
        w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(f"{self.data_path}/_v={attempt}")
        return attempt, int(obs.get.get("rows", 0))

    def _commit(self, version: int, operation: str, versions: list[int], schema: StructType,
                rows: int, inserted: int | None = None, updated: int | None = None,
                partition_by: list[str] | None = None, folders: list[str] | None = None,
                buckets: int | None = None, bucket_by: list[str] | None = None) -> int:
        if self.version() >= version:
            raise RuntimeError(f"version {version} of {self.root} is already taken")
        row = [(version, _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None), operation,
                versions, schema.json(), rows, inserted, updated, partition_by, folders, buckets,
                bucket_by)]
        self.spark.createDataFrame(row, _LOG_SCHEMA).coalesce(1).write.mode("append") \
            .parquet(self.log_path)
        return version

    def create_if_absent(self, schema: StructType, buckets: int | None = None,
                         bucket_by: list[str] | None = None) -> bool:
        """Declare an empty table (S20), in ``buckets`` by the keys ``bucket_by`` if given; an
        existing table is left as it is."""
        if self.exists():
            return False
        if buckets and not bucket_by:
            raise ValueError("buckets need the keys they are made of")
        self._commit(1, "create", [], schema, 0, buckets=buckets, bucket_by=bucket_by)
        return True

    # -- buckets -------------------------------------------------------------------------
    def _write_buckets(self, df: DataFrame, h, rows: int) -> tuple[int, list[str], int]:
        """Write rows that carry their bucket; (attempt, its folders, rows). ``rows``: about how
        many there are, so that a large bucket is written by several tasks."""
        deal = [F.col(_BUCKET)]
        split = -(-rows // (h.buckets * TASK_ROWS))
        if split > 1:
            deal.append(F.pmod(F.xxhash64(F.lit("split"), *[F.col(f"`{k}`").cast("string")
                                                            for k in h.bucket_by]), F.lit(split)))
        attempt, n = self._write(df.repartition(*deal), [_BUCKET])
        made = folders(self.spark, f"{self.data_path}/_v={attempt}")
        return attempt, [f"_v={attempt}/{x}" for x in made if x.startswith(f"{_BUCKET}=")], n

    def _commit_buckets(self, h, operation: str, schema: StructType, live: list[str], rows: int,
                        inserted: int, updated: int) -> None:
        versions = sorted({int(x.split("/")[0][3:]) for x in live})
        self._commit(int(h.version) + 1, operation, versions, schema, rows, inserted, updated,
                     h.partition_by, live, h.buckets, h.bucket_by)

    def _overwrite_buckets(self, df: DataFrame, h, operation: str, inserted, updated) -> int:
        rows = df.withColumn(_BUCKET, bucket_of(h.bucket_by, h.buckets))
        _, live, n = self._write_buckets(rows, h, int(h.rows or 0))
        self._commit_buckets(h, operation, df.schema, live, n, inserted, updated)
        return int(h.version) + 1

    def _append_buckets(self, df: DataFrame, h) -> int:
        old, df = align(self._read(h), df)
        live, before = list(h.folders or []), int(h.rows or 0)
        if old is not None and before and _recast(old.schema, self._read(h).schema):
            df, live = old.unionByName(df), []          # a type widened
        rows = df.withColumn(_BUCKET, bucket_of(h.bucket_by, h.buckets))
        _, made, n = self._write_buckets(rows, h, before)
        n -= 0 if live or not before else before
        self._commit_buckets(h, "append", df.schema, live + made, before + n, n, 0)
        return n

    def _upsert_buckets(self, h, target: DataFrame, source: DataFrame, keys, order_by, strategy,
                        keep_target, recast: bool) -> tuple[int, int]:
        from fileflow.operators.upsert import count_exprs, merge
        place = bucket_of(keys, h.buckets)
        live = list(h.folders or [])
        touched = {int(r[0]) for r in source.select(place.alias("b")).distinct().collect()}
        if recast:
            touched |= set(range(-1, h.buckets))
        # rows with a null key match nothing: their files stay, new ones are added
        stay = [x for x in live if _number(x) not in touched or _number(x) == -1 and not recast]
        read = [x for x in live if x not in set(stay)]
        old = self._files(StructType.fromJson(json.loads(h.schema_json)), read)
        old = old.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name)
                           if f.name in old.columns else F.lit(None).cast(f.dataType)
                           .alias(f.name) for f in target.schema.fields])
        if strategy == "auto" and not read:
            strategy = "insert"
        m = merge(old, source, keys, order_by, strategy, keep_target=keep_target)
        obs = Observation(f"merge_{uuid.uuid4().hex[:8]}")
        out = m.flagged.observe(obs, *count_exprs()).drop("_kind", "_n")
        _, made, _ = self._write_buckets(out.withColumn(_BUCKET, place), h, int(h.rows or 0))
        ins, upd = (int(obs.get.get(k, 0)) for k in ("inserted", "updated"))
        self._commit_buckets(h, "merge", out.schema, stay + made, int(h.rows or 0) + ins, ins, upd)
        return ins, upd

    def overwrite(self, df: DataFrame, operation: str = "overwrite",
                  partition_by: list[str] | None = None, inserted: int | None = None,
                  updated: int | None = None) -> int:
        h = self.head()
        if h is not None and h.buckets:
            return self._overwrite_buckets(df, h, operation, inserted, updated)
        v = int(h.version) + 1 if h else 1
        parts = partition_by or (h.partition_by if h else None)
        attempt, rows = self._write(df, parts)
        return self._commit(v, operation, [attempt], df.schema, rows, inserted, updated, parts)

    def append(self, df: DataFrame, partition_by: list[str] | None = None) -> int:
        """Bulk insert (S18): new files only, earlier files are referenced, not rewritten.

        Returns the number of rows appended (0 for empty input)."""
        h = self.head()
        if h is not None and h.buckets:
            return self._append_buckets(df, h)
        v = (int(h.version) if h else 0) + 1
        parts = partition_by or (h.partition_by if h else None)
        old_paths = list(h.versions) if h else []
        if h is not None:
            old, df = align(self._read(h), df)
            if old is not None and h.rows:      # a type widened: earlier files are rewritten
                attempt, rows = self._write(old.unionByName(df), parts)
                self._commit(v, "append", [attempt], df.schema, rows, rows - h.rows, 0, parts)
                return rows - h.rows
        attempt, rows = self._write(df, parts)
        self._commit(v, "append", old_paths + [attempt], df.schema,
                     (h.rows if h else 0) + rows, rows, 0, parts)
        return rows

    def upsert(self, source: DataFrame, keys: list[str], order_by: list[str] | None = None,
               strategy: str = "auto", keep_target: tuple[str, ...] = (),
               buckets: int | None = None) -> tuple[int, int]:
        """W1 against this table: merge, write a new version, publish; (inserted, updated).

        A table that is made here gets ``buckets`` by ``keys`` (if given); a table in buckets of
        these keys has only the touched ones rewritten."""
        from fileflow.operators.upsert import check_keys, count_exprs, merge
        check_keys(source, keys, "source")
        if not self.exists():
            self.create_if_absent(source.schema, buckets, list(keys) if buckets else None)
        h = self.head()
        target = self._read(h)
        held = target.schema
        # wide mode: the table evolves by name (new source columns start out NULL) and by type
        # (a column whose type differs from the table's is widened on both sides)
        wide, source = align(target, source, fill=False)
        target = wide if wide is not None else target
        missing = [f for f in source.schema.fields if f.name not in target.columns]
        if missing:
            target = target.select("*", *[F.lit(None).cast(f.dataType).alias(f.name)
                                          for f in missing])
        if source.isEmpty():
            return 0, 0
        if h.buckets and set(h.bucket_by) == set(keys):
            return self._upsert_buckets(h, target, source, list(h.bucket_by), order_by, strategy,
                                        keep_target, _recast(target.schema, held))
        if strategy == "auto" and h is not None and h.rows == 0:
            strategy = "insert"      # the log says the table is empty: nothing to match
        m = merge(target, source, keys, order_by, strategy, keep_target=keep_target)
        # counts ride along the write through an Observation: the merge runs once
        obs = Observation(f"merge_{uuid.uuid4().hex[:8]}")
        out = m.flagged.observe(obs, *count_exprs()).drop("_kind", "_n")
        if h.buckets:                    # matched on other keys than the buckets are made of
            _, live, rows = self._write_buckets(out.withColumn(_BUCKET, bucket_of(
                h.bucket_by, h.buckets)), h, int(h.rows or 0))
            ins, upd = (int(obs.get.get(k, 0)) for k in ("inserted", "updated"))
            self._commit_buckets(h, "merge", out.schema, live, rows, ins, upd)
            return ins, upd
        v = int(h.version) + 1
        attempt, rows = self._write(out, h.partition_by)
        got = obs.get
        ins, upd = int(got.get("inserted", 0)), int(got.get("updated", 0))
        self._commit(v, "merge", [attempt], out.schema, rows, ins, upd, h.partition_by)
        return ins, upd


def bucket_of(keys: list[str], buckets: int):
    """A row's bucket, by the text of its keys; -1 where a key is NULL."""
    texts = [F.col(f"`{k}`").cast("string") for k in keys]
    known = reduce(lambda a, b: a & b, [t.isNotNull() for t in texts])
    return F.when(known, F.pmod(F.xxhash64(*texts), F.lit(buckets))).otherwise(-1).cast("int")


def _number(folder: str) -> int:
    return int(folder.rsplit("=", 1)[1])


def _recast(new: StructType, old: StructType) -> bool:
    """Whether a column of ``old`` has another type in ``new`` (new columns do not count: files
    without them read as NULL)."""
    return any(f.dataType != new[f.name].dataType for f in old.fields if f.name in new.names)


_WHOLE = (ByteType, ShortType, IntegerType, LongType)
_FLOAT = (FloatType, DoubleType)


def _values_decide(a: DataType, b: DataType) -> bool:
    """Whole or decimal numbers meet doubles: whether a double holds them is up to the values."""
    return isinstance(a, NumericType) and isinstance(b, NumericType) \
        and isinstance(a, _FLOAT) != isinstance(b, _FLOAT)


def wider(a: DataType, b: DataType) -> DataType:
    """The type that holds values of both: whole numbers -> bigint or decimal, numbers -> double
    (``align`` looks at the values first), dates and times -> timestamp, NULLs -> the other,
    anything else -> string."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
        return LongType()
    if isinstance(a, _FLOAT) and isinstance(b, _FLOAT):
        return DoubleType()
    if isinstance(a, NumericType) and isinstance(b, NumericType):
        if _values_decide(a, b):
            return DoubleType()
        digits, scale = (max(x) for x in zip(*((t.precision - t.scale, t.scale) if isinstance(
            t, DecimalType) else (19, 0) for t in (a, b))))
        return DecimalType(38, scale) if digits + scale <= 38 else StringType()
    if isinstance(a, (DateType, TimestampType)) and isinstance(b, (DateType, TimestampType)):
        return TimestampType()
    return StringType()


def align(table: DataFrame, df: DataFrame, fill: bool = True):
    """(the table with widened types, or None if no type changes; ``df`` in the same types).

    ``fill``: ``df`` gets the table's column order and NULLs for columns that it lacks; new
    columns are kept at the end."""
    types = {f.name: f.dataType for f in table.schema.fields}
    new = {f.name: number_type(table, df, f.name) if _values_decide(types[f.name], f.dataType)
           else wider(types[f.name], f.dataType) for f in df.schema.fields if f.name in types}
    changed = any(new.get(c, t) != t for c, t in types.items()) \
        or fill and any(c not in types for c in df.columns)

    def cast(c: str):
        return F.col(f"`{c}`").cast(new[c]).alias(c) if c in new else F.col(f"`{c}`")

    if fill:
        cols = [cast(c) if c in df.columns else F.lit(None).cast(t).alias(c)
                for c, t in types.items()]
        cols += [F.col(f"`{c}`") for c in df.columns if c not in types]
    else:
        cols = [cast(c) for c in df.columns]
    wide = table.select(*[cast(c) for c in types],
                        *[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields
                          if fill and f.name not in types]) if changed else None
    return wide, df.select(*cols)
