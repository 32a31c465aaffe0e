"""Post-load quality checks (A11, A13, A14) and the check-suite rollup.

Every check yields rows of the ``CHECK`` schema: (check, ok, observed, detail).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fileflow.operators.contracts import duplicate_keys
from fileflow.operators.records import _bound, since_day_start


def rows_loaded_since(df: DataFrame, as_of, time_col: str = "loaded_at",
                      name: str = "rows_loaded_today") -> DataFrame:
    """Rows loaded on/after midnight of ``as_of`` must be > 0."""
    n = since_day_start(df, time_col, as_of).agg(F.count(F.lit(1)).alias("observed"))
    return n.select(F.lit(name).alias("check"), (F.col("observed") > 0).alias("ok"),
                    F.col("observed").cast("long").alias("observed"),
                    F.lit(f"{time_col} >= day start").alias("detail"))


def all_null_columns(df: DataFrame, name: str = "no_all_null_columns") -> DataFrame:
    """Per column: is every value NULL? One pass, one check row per column."""
    cols = df.columns
    wide = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c}', c{i}" for i, c in enumerate(cols))
    long = wide.selectExpr(f"stack({len(cols)}, {pairs}) as (col_name, non_null)")
    return long.select(F.concat(F.lit(name + ":"), "col_name").alias("check"),
                       (F.col("non_null") > 0).alias("ok"),
                       F.col("non_null").cast("long").alias("observed"),
                       F.lit("non-null values").alias("detail"))


def loaded_and_filled(df: DataFrame, as_of, columns: list[str] | None = None,
                      time_col: str = "loaded_at") -> DataFrame:
    """A11 and A13 from one scan: the rows of ``rows_loaded_since`` and ``all_null_columns``."""
    cols = list(df.columns if columns is None else columns)
    bound = F.col(time_col) >= _bound(df, time_col, str(as_of)[:10])
    wide = df.agg(F.count_if(bound).alias("n"),
                  *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(cols)])
    rows = [f"'rows_loaded_today', n, '{time_col} >= day start'"]
    rows += ["'no_all_null_columns:" + c.replace("'", "\\'") + f"', c{i}, 'non-null values'"
             for i, c in enumerate(cols)]
    long = wide.selectExpr(f"stack({len(rows)}, {', '.join(rows)}) as (check, observed, detail)")
    return long.select("check", (F.col("observed") > 0).alias("ok"),
                       F.col("observed").cast("long").alias("observed"), "detail")


def no_duplicates(df: DataFrame, keys: list[str], name: str = "no_duplicate_keys") -> DataFrame:
    """Surplus rows over the natural key must be 0."""
    d = duplicate_keys(df, keys).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("observed"),
        F.count(F.lit(1)).alias("groups"))
    return d.select(F.lit(name).alias("check"), (F.col("observed") == 0).alias("ok"),
                    "observed",
                    F.concat(F.lit("duplicate groups: "), F.col("groups").cast("string"))
                    .alias("detail"))


def suite(*checks: DataFrame) -> DataFrame:
    """Union of check rows."""
    return reduce(DataFrame.unionByName, checks)


def rollup(checks: DataFrame) -> DataFrame:
    """passed / total, failing names (sorted) and overall ok."""
    return checks.agg(
        F.count_if(F.col("ok")).cast("long").alias("passed"),
        F.count(F.lit(1)).alias("total"),
        F.coalesce(F.bool_and("ok"), F.lit(True)).alias("ok"),
        F.array_join(F.array_sort(F.collect_list(F.when(~F.col("ok"), F.col("check")))), ",")
        .alias("failing"))


class QualityGateError(Exception):
    pass


def enforce(checks: DataFrame) -> None:
    """Raise when any check fails (strict mode)."""
    r = rollup(checks).first()
    if not r.ok:
        raise QualityGateError(f"quality checks failed: {r.failing}")
