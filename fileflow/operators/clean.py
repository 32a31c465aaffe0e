"""Cleaning steps (P1-P5, P7, P14). Each is ``DataFrame -> DataFrame`` and chains with
``df.transform``; none collects data (header names are metadata)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from fileflow.functions.dates import parse_timestamp
from fileflow.functions.strings import na_to_null, normalize_names, unicode_strip
from fileflow.session import materialize

FILE_COL = "_file"
BLOCK_COL = "_block"


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def normalize_columns(df: DataFrame, keep: tuple[str, ...] = (FILE_COL, BLOCK_COL)) -> DataFrame:
    """Lower-case snake_case headers (P1) with the empty / duplicate rules of survey Q3."""
    data_cols = [c for c in df.columns if c not in keep]
    new = dict(zip(data_cols, normalize_names(data_cols)))
    return df.toDF(*[new.get(c, c) for c in df.columns])


def drop_empty_rows(df: DataFrame, ignore: tuple[str, ...] = (FILE_COL, BLOCK_COL)) -> DataFrame:
    """Drop rows whose data columns are all NULL (NaN counts as NULL)."""
    cols = [c for c in df.columns if c not in ignore]
    if not cols:
        return df
    return df.na.drop(how="all", subset=cols)


def null_na_tokens(df: DataFrame, tokens: list[str] | None = None) -> DataFrame:
    """Map NA tokens to NULL in every string column (survey Q7d)."""
    return df.select(*[na_to_null(_q(f.name), tokens).alias(f.name)
                       if isinstance(f.dataType, StringType) and f.name not in (FILE_COL,)
                       else _q(f.name) for f in df.schema.fields])


def strip_strings(df: DataFrame, ignore: tuple[str, ...] = (FILE_COL,)) -> DataFrame:
    """Strip Unicode whitespace from every string column (P3). Run after P2, so a
    whitespace-only row survives as ''."""
    return df.select(*[unicode_strip(_q(f.name)).alias(f.name)
                       if isinstance(f.dataType, StringType) and f.name not in ignore
                       else _q(f.name) for f in df.schema.fields])


def coerce_dates(df: DataFrame, columns: list[str], formats: list[str] | None = None) -> DataFrame:
    """Listed columns that exist become timestamps; unparseable values become NULL."""
    types = {f.name: f.dataType for f in df.schema.fields}
    present = [c for c in columns if c in types]
    if not present:
        return df
    return df.select(*[parse_timestamp(_q(c), formats, types[c]).alias(c) if c in present
                       else _q(c) for c in df.columns])


def add_audit(df: DataFrame, source_file: Column | str | None = None,
              loaded_at: Column | None = None) -> DataFrame:
    """``source_file`` and ``loaded_at`` audit columns (P5). ``loaded_at`` defaults to the
    query's current timestamp (one value per query)."""
    sf = source_file if source_file is not None else F.col(FILE_COL)
    sf = F.col(sf) if isinstance(sf, str) else sf
    la = loaded_at if loaded_at is not None else F.current_timestamp()
    return df.withColumn("source_file", sf).withColumn("loaded_at", la)


BROADCAST_MAX_SPLITS = 2_000_000


def split_offsets(tagged: DataFrame, file_col: str = FILE_COL, block_col: str = BLOCK_COL,
                  extra_aggs: list[Column] | None = None):
    """Per-split statistics of ``tagged`` (rows carrying ``_mid``), written once to the shared
    folder (one row per split) so later uses do not re-read the input.

    Returns (stats, offsets): stats has one row per input split (first id ``_m0``, row count
    ``_n`` and any ``extra_aggs``); offsets adds the running row count of earlier splits of
    the same file. Offsets come back broadcast-hinted when the split count (known exactly
    from the checkpoint) is under ``BROADCAST_MAX_SPLITS``; otherwise Spark joins by shuffle.
    """
    aggs = [F.min("_mid").alias("_m0"), F.count(F.lit(1)).alias("_n")] + list(extra_aggs or [])
    stats = materialize(tagged.groupBy(file_col, block_col).agg(*aggs), "split-stats")
    w = Window.partitionBy(file_col).orderBy(block_col) \
        .rowsBetween(Window.unboundedPreceding, -1)
    offs = stats.select(file_col, block_col, "_m0",
                        F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    if stats.count() <= BROADCAST_MAX_SPLITS:
        offs = F.broadcast(offs)
    return stats, offs


def with_row_ids(df: DataFrame, file_col: str = FILE_COL, block_col: str = BLOCK_COL,
                 name: str = "row_id") -> DataFrame:
    """Dense 0..n-1 per file, in file order, without sorting any file in one task.

    Input rows carry the file path and the start offset of the input split they were read
    from (``_metadata.file_path`` / ``_metadata.file_block_start``). Inside one split the rows
    arrive in file order, so ``monotonically_increasing_id`` minus its minimum over the split
    is the position in the split; a running sum of split sizes, ordered by split start within
    each file, gives the split's offset (see ``split_offsets``). The tagged rows are written
    once, so both uses see the same splits. Skipped when ``row_id`` exists.
    """
    if name in df.columns:
        return df
    tagged = materialize(df.withColumn("_mid", F.monotonically_increasing_id()), "row-ids")
    _, offs = split_offsets(tagged, file_col, block_col)
    out = tagged.join(offs, [file_col, block_col], "inner")
    return out.withColumn(name, (F.col("_off") + F.col("_mid") - F.col("_m0")).cast("long")) \
        .drop("_mid", "_m0", "_off")


def pack_json(df: DataFrame, keep: list[str], name: str = "data_json") -> DataFrame:
    """Everything except ``keep`` packed into one JSON text column, NULL fields kept."""
    rest = [c for c in df.columns if c not in keep]
    js = F.to_json(F.struct(*[_q(c) for c in rest]), {"ignoreNullFields": "false"})
    return df.select(*[_q(c) for c in keep], js.alias(name))
