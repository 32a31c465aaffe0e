"""Upsert (MERGE) on natural keys, last writer wins (W1, J1, N3); run records.

Plan shape
----------
1. Source rows with a NULL in any key never match (SQL ``=``) and are inserted as they are.
2. Non-null-key rows are reduced to one row per key with ``max_by(payload, ordering)``: a
   sort-aggregate with a partial (map-side) step, so a hot key is collapsed inside each map
   task before anything is shuffled — a key holding a third of the input costs one row per
   map task, not one giant task. ``ordering`` is (order_by..., every other column), a total
   order, so the winner is deterministic.
3. Matching against the target:
   * ``broadcast`` — when the reduced source is small (measured rows and bytes, checked
     against limits), the target is never shuffled: a broadcast left join rewrites matched
     rows, and a broadcast semi join finds which source keys already exist.
   * ``shuffle`` — otherwise a full outer equi-join, both sides hash-partitioned on the keys
     (1:1 after step 2, so no skew remains). AQE coalesces / splits partitions at run time.
4. Counts (survey Q1): a key not in the target with n source rows = 1 insert + (n-1)
   updates; a matched key = n updates; every NULL-key row is an insert.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from fileflow.session import materialize

BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 256 * 1024 * 1024


@dataclass
class Merge:
    result: DataFrame        # the full new table
    counts: DataFrame        # one row: inserted, updated
    strategy: str
    flagged: DataFrame       # result + _kind (keep/update/insert) + _n, for Observation


def count_exprs() -> list[Column]:
    """Inserted / updated counts over ``Merge.flagged`` (survey Q1 rule)."""
    k = F.col("_kind")
    return [F.coalesce(F.sum(F.when(k == "insert", 1).otherwise(0)), F.lit(0)).cast("long")
            .alias("inserted"),
            F.coalesce(F.sum(F.when(k == "update", F.col("_n"))
                             .when(k == "insert", F.col("_n") - 1).otherwise(0)), F.lit(0))
            .cast("long").alias("updated")]


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def _null_key(keys: list[str]) -> Column:
    e = None
    for k in keys:
        x = _q(k).isNull()
        e = x if e is None else e | x
    return e


def check_keys(df: DataFrame, keys, what: str) -> None:
    if isinstance(keys, str) or not keys:
        raise TypeError("natural keys must be a non-empty list of column names (survey Q16)")
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks key columns {missing}")


def reduce_source(source: DataFrame, keys: list[str], order_by: list[str] | None) -> DataFrame:
    """One row per non-null key (the last in ``order_by`` order) plus ``_n`` = rows seen."""
    nonkey = [c for c in source.columns if c not in keys]
    order = list(order_by or [])
    tie = [c for c in nonkey if c not in order]
    ok = source.filter(~_null_key(keys))
    aggs = [F.count(F.lit(1)).alias("_n")]
    if nonkey:
        payload = F.struct(*[_q(c).alias(c) for c in nonkey])
        ordering = F.struct(*[_q(c).alias(c) for c in order + tie])
        aggs.insert(0, F.max_by(payload, ordering).alias("_p"))
    red = ok.groupBy(*[_q(k) for k in keys]).agg(*aggs)
    cols = [_q(k) for k in keys] + ([F.col(f"_p.`{c}`").alias(c) for c in nonkey]) + ["_n"]
    return red.select(*cols)


def measure(df: DataFrame) -> tuple[int, int]:
    """(rows, approximate bytes) of ``df`` in one aggregate pass; strings and binaries by length,
    nested values by the length of their JSON text."""
    size: Column = F.lit(0)
    for f in df.schema.fields:
        if isinstance(f.dataType, (StringType, BinaryType)):
            size = size + F.coalesce(F.octet_length(_q(f.name)), F.lit(0))
        elif isinstance(f.dataType, (ArrayType, MapType, StructType)):
            text = F.to_json(F.struct(_q(f.name)))
            size = size + F.coalesce(F.octet_length(text), F.lit(0))
        else:
            size = size + F.lit(16)
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("b")).first()
    return int(r.n), int(r.b or 0)


def _project(keys, t_cols, s_cols, from_src: Column, t_pref: str, s_pref: str,
             keep_target: tuple[str, ...] = ()):
    """Output columns: target order first, then source-only columns (wide mode).

    Rows the source touched (updates and inserts) take the source's values; target-only
    columns keep the target's value (NULL for inserts). ``keep_target`` columns keep an
    existing target value (e.g. an identity assigned at first insert)."""
    out = []
    for c in t_cols:
        if c in keys:
            out.append(_q(c))
        elif c in s_cols and c in keep_target:
            out.append(F.coalesce(F.col(f"`{t_pref}{c}`"), F.col(f"`{s_pref}{c}`")).alias(c))
        elif c in s_cols:
            out.append(F.when(from_src, F.col(f"`{s_pref}{c}`"))
                       .otherwise(F.col(f"`{t_pref}{c}`")).alias(c))
        else:
            out.append(F.col(f"`{t_pref}{c}`").alias(c))
    for c in s_cols:
        if c not in t_cols and c not in keys:
            out.append(F.col(f"`{s_pref}{c}`").alias(c))
    return out


def merge(target: DataFrame, source: DataFrame, keys: list[str],
          order_by: list[str] | None = None, strategy: str = "auto",
          max_broadcast_rows: int = BROADCAST_MAX_ROWS,
          max_broadcast_bytes: int = BROADCAST_MAX_BYTES,
          keep_target: tuple[str, ...] = ()) -> Merge:
    """MERGE ``source`` into ``target`` on ``keys``; returns the new table and the counts.

    ``order_by`` names source columns giving input order (last wins), e.g.
    ``["source_file", "row_id"]``. If every column is a key, this is insert-if-absent.
    """
    check_keys(target, keys, "target")
    check_keys(source, keys, "source")
    order = order_by
    if order is None:
        order = [c for c in ("source_file", "row_id") if c in source.columns]
    s_cols = [c for c in source.columns if c not in keys]
    t_cols = list(target.columns)
    nulls = source.filter(_null_key(keys))
    red = reduce_source(source, keys, order)

    if strategy == "insert":
        # the caller knows the target is empty: every reduced row is an insert, no join
        pass
    elif strategy == "auto":
        # the reduced source is written once to the shared checkpoint folder: the size check
        # and the join both read it, so the dedup aggregate runs once and the merge restarts
        # from here if an executor is lost
        red = materialize(red, "merge-source")
        n, b = measure(red)
        strategy = "broadcast" if (n <= max_broadcast_rows and b <= max_broadcast_bytes) \
            else "shuffle"

    s = red.select(*[_q(k) for k in keys], *[_q(c).alias(f"_s_{c}") for c in s_cols],
                   "_n", F.lit(True).alias("_m"))
    t = target.select(*[_q(k) for k in keys],
                      *[_q(c).alias(f"_t_{c}") for c in t_cols if c not in keys],
                      F.lit(True).alias("_t"))
    matched = F.col("_m").isNotNull() & F.col("_t").isNotNull()

    if strategy == "insert":
        joined = s.select("*", F.lit(None).cast("boolean").alias("_t"),
                          *[F.lit(None).cast(target.schema[c].dataType).alias(f"_t_{c}")
                            for c in t_cols if c not in keys])
    elif strategy == "broadcast":
        upd = t.join(F.broadcast(s), keys, "left")
        existing = t.select(*keys).join(F.broadcast(s.select(*keys)), keys, "left_semi") \
            .distinct()
        ins = s.join(F.broadcast(existing), keys, "left_anti")
        ins = ins.select("*", F.lit(None).cast("boolean").alias("_t"),
                         *[F.lit(None).cast(target.schema[c].dataType).alias(f"_t_{c}")
                           for c in t_cols if c not in keys])
        joined = upd.unionByName(ins, allowMissingColumns=True)
    else:
        joined = t.join(s, keys, "full_outer")

    kind = F.when(matched, F.lit("update")).when(F.col("_m").isNotNull(), F.lit("insert")) \
        .otherwise(F.lit("keep"))
    from_src = F.col("_m").isNotNull()
    body = joined.select(*_project(keys, t_cols, s_cols, from_src, "_t_", "_s_", keep_target),
                         kind.alias("_kind"), F.coalesce(F.col("_n"), F.lit(0)).alias("_n"))
    null_rows = nulls.select(*[(_q(c) if c in source.columns else
                                F.lit(None).cast(target.schema[c].dataType)).alias(c)
                               for c in t_cols],
                             *[_q(c) for c in source.columns if c not in t_cols],
                             F.lit("insert").alias("_kind"), F.lit(1).cast("long").alias("_n"))
    flagged = body.unionByName(null_rows, allowMissingColumns=True)
    result = flagged.drop("_kind", "_n")
    counts = flagged.agg(*count_exprs())
    return Merge(result, counts, strategy, flagged)


# --- W3: run records ------------------------------------------------------------------------

ERROR_MAX = 4000


def merge_runs(target: DataFrame, updates: DataFrame, now) -> DataFrame:
    """Run-record upsert keyed by ``run_id``.

    matched  -> status, end_time = now, counters and error from the update; dag_id and
                start_time stay;
    new      -> inserted with start_time = now and no end_time.
    Error text is cut to 4000 characters; '' is stored as NULL. Several updates for one
    run_id: the last in ``seq`` order (or all-column order) wins.
    """
    now_c = now if isinstance(now, Column) else F.lit(now)
    now_c = now_c.cast(target.schema["start_time"].dataType)
    cols = ["dag_id", "status", "files_processed", "rows_inserted", "rows_updated",
            "error_message"]
    order = ["seq"] if "seq" in updates.columns else None
    u = updates.withColumn("error_message",
                           F.substring(F.nullif(F.col("error_message"), F.lit("")), 1, ERROR_MAX))
    red = reduce_source(u.select("run_id", *cols, *(order or [])), ["run_id"], order)
    s = red.select("run_id", *[F.col(c).alias(f"_s_{c}") for c in cols], F.lit(True).alias("_m"))
    t = target.select("run_id", *[F.col(c).alias(f"_t_{c}") for c in target.columns
                                  if c != "run_id"], F.lit(True).alias("_t"))
    j = t.join(s, "run_id", "full_outer")
    m = F.col("_m").isNotNull()
    is_new = m & F.col("_t").isNull()
    out = []
    for c in target.columns:
        if c == "run_id":
            out.append(F.col("run_id"))
        elif c == "dag_id":
            out.append(F.when(is_new, F.col("_s_dag_id")).otherwise(F.col("_t_dag_id")).alias(c))
        elif c == "start_time":
            out.append(F.when(is_new, now_c).otherwise(F.col("_t_start_time")).alias(c))
        elif c == "end_time":
            out.append(F.when(is_new, F.lit(None).cast(target.schema[c].dataType))
                       .when(m, now_c).otherwise(F.col("_t_end_time")).alias(c))
        elif c in cols:
            out.append(F.when(m, F.col(f"_s_{c}")).otherwise(F.col(f"_t_{c}")).alias(c))
        else:
            out.append(F.col(f"_t_{c}").alias(c))
    return j.select(*out)
