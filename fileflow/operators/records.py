"""Record reads: date-range filter (P8), point lookup (P9), pages (L2, N1), today (P10)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_PAGE = 5000
TOPK_MAX = 100_000          # offset + limit above this: numbered by a distributed sort


def _bound(df: DataFrame, time_col: str, day: str, plus_days: int = 0) -> Column:
    """A literal midnight bound typed like ``time_col`` so the filter folds and pushes down."""
    d = _dt.date.fromisoformat(day) + _dt.timedelta(days=plus_days)
    dtype = df.schema[time_col].dataType.simpleString()
    if dtype == "date":
        dtype = "timestamp"
    return F.lit(d.isoformat()).cast(dtype)


def date_range(df: DataFrame, time_col: str = "loaded_at", date_from: str = "",
               date_to: str = "") -> DataFrame:
    """``time_col >= from`` and ``time_col <= to + 1 day`` (next midnight included, survey Q22).

    Empty strings mean no bound. Both bounds are literals, so Parquet gets PushedFilters.
    """
    out = df
    if date_from:
        out = out.filter(F.col(time_col) >= _bound(df, time_col, date_from))
    if date_to:
        out = out.filter(F.col(time_col) <= _bound(df, time_col, date_to, 1))
    return out


def lookup(df: DataFrame, key_col: str, value) -> DataFrame:
    """Point lookup; an empty result is the not-found signal."""
    return df.filter(F.col(key_col) == F.lit(value))


def since_day_start(df: DataFrame, time_col: str, as_of: str | _dt.date) -> DataFrame:
    """Rows with ``time_col`` on or after midnight of ``as_of`` (P10: TRUNC(SYSDATE))."""
    day = as_of.isoformat() if isinstance(as_of, _dt.date) else str(as_of)[:10]
    return df.filter(F.col(time_col) >= _bound(df, time_col, day))


def on_day(df: DataFrame, time_col: str, as_of: str | _dt.date) -> DataFrame:
    """Rows whose ``time_col`` falls on the calendar day ``as_of`` (TRUNC(x) = TRUNC(SYSDATE))."""
    day = as_of.isoformat() if isinstance(as_of, _dt.date) else str(as_of)[:10]
    return df.filter((F.col(time_col) >= _bound(df, time_col, day))
                     & (F.col(time_col) < _bound(df, time_col, day, 1)))


def page(df: DataFrame, order_by: list[str] | None = None, limit: int = 100, offset: int = 0,
         with_rn: bool = False) -> DataFrame:
    """One page of rows in a stable order (L2); optionally with a 1-based ``rn``.

    ``order_by`` defaults to all columns, which makes the order total (survey Q5). The top
    ``offset + limit`` rows are taken with a bounded top-k (TakeOrderedAndProject), so no
    global sort or single-partition window ever sees the whole table; ``rn`` is numbered
    over those few rows only. Past ``TOPK_MAX`` rows the page comes from a distributed sort
    with dense row numbers instead, so memory per task stays bounded at any depth.
    """
    if not 1 <= limit <= MAX_PAGE:
        raise ValueError(f"limit must be within 1..{MAX_PAGE}")
    if offset < 0:
        raise ValueError("offset must be >= 0")
    keys = list(order_by) if order_by else list(df.columns)
    ordered = [F.col(k).asc_nulls_last() for k in keys]
    if offset + limit > TOPK_MAX:
        # deep page: a top-k heap of offset+limit rows per task would not be bounded; number
        # the rows with a distributed sort instead (written once, no single-task step)
        from fileflow.operators.identity import dense_index
        idx = dense_index(df, "_rn", start=1, order_by=ordered)
        out = idx.filter((F.col("_rn") > offset) & (F.col("_rn") <= offset + limit))
        out = out.orderBy("_rn")
        return out.withColumnRenamed("_rn", "rn") if with_rn else out.drop("_rn")
    if not with_rn:
        return df.orderBy(*ordered).offset(offset).limit(limit)
    top = df.orderBy(*ordered).limit(offset + limit)
    w = Window.orderBy(*ordered)
    return top.withColumn("rn", F.row_number().over(w).cast("long")) \
        .filter(F.col("rn") > offset)


def page_after(df: DataFrame, order_by: list[str], after: list | None = None,
               limit: int = 100) -> DataFrame:
    """The page that follows a known row (L2 by key): ``after`` holds that row's values of the
    ``order_by`` columns (non-null, together unique); None gives the first page.

    The bound on the first column is a plain comparison with a literal, so Parquet skips what
    lies before it; the rest is one bounded top-k, whatever the depth of the page.
    """
    if not 1 <= limit <= MAX_PAGE:
        raise ValueError(f"limit must be within 1..{MAX_PAGE}")
    out = df
    if after is not None:
        if len(after) != len(order_by) or any(v is None for v in after):
            raise ValueError("after needs one non-null value for each order_by column")
        lits = [F.lit(v).cast(df.schema[c].dataType) for c, v in zip(order_by, after)]
        later = F.lit(False)
        for c, v in reversed(list(zip(order_by, lits))):
            later = (F.col(c) > v) | ((F.col(c) == v) & later)
        out = out.filter(F.col(order_by[0]) >= lits[0]).filter(later)
    return out.orderBy(*[F.col(c).asc() for c in order_by]).limit(limit)


def total(df: DataFrame) -> DataFrame:
    """Row count as a one-row DataFrame (A1); pairs with ``page`` for the response total."""
    return df.agg(F.count(F.lit(1)).alias("total"))
