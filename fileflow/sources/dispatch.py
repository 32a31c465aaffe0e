"""Format dispatch (S9): workbook extensions go to the workbook reader, everything else to
the CSV reader; the two results are unioned by column name."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fileflow.functions.paths import extension
from fileflow.operators.table import align
from fileflow.sources.csv import read_csv
from fileflow.sources.discover import EXCEL_EXTENSIONS
from fileflow.sources.excel import read_excel
from fileflow.sources.profile import PROFILE_COLUMNS


@dataclass
class ReadResult:
    data: DataFrame
    rejects: DataFrame


def _with_content(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Rows with ``content``; a bare listing is read from its paths."""
    if "content" in files.columns:
        return files
    paths = [x.path for x in files.select("path").collect()]
    return spark.read.format("binaryFile").load(paths).select("path", "content")


def read_files(spark: SparkSession, files: DataFrame | None, *,
               chunks: DataFrame | None = None, root: str | None = None,
               date_columns: list[str] | tuple[str, ...] = (), delimiter: str | None = None,
               encoding: str | None = None, sheet: int | str | None = 0, header_row: int = 0,
               skip_rows: int = 0, loaded_at=None) -> ReadResult:
    """``files``: rows with ``path`` (and ``content`` when available, e.g. from bronze).
    ``chunks``: CSV files in chunks, read in ranges."""
    parts, rejects, kinds = [], [], set()
    ext = extension("path")
    if files is not None:
        books = files.filter(ext.isin(EXCEL_EXTENSIONS))
        texts = files.filter(~ext.isin(EXCEL_EXTENSIONS))
        kinds = {r[0] for r in files.select(ext.isin(EXCEL_EXTENSIONS)).distinct().collect()}
    if chunks is not None and not chunks.isEmpty():
        r = read_csv(spark, chunks, delimiter=delimiter, encoding=encoding,
                     date_columns=date_columns, root=root, loaded_at=loaded_at)
        parts.append(r.data)
        rejects.append(r.rejects)
    if False in kinds:
        # profiles computed at landing (bronze) spare a second read of the CSV bytes
        known = set(PROFILE_COLUMNS) <= set(texts.columns) and delimiter is None \
            and encoding is None
        r = read_csv(spark, _with_content(spark, texts), delimiter=delimiter, encoding=encoding,
                     date_columns=date_columns, root=root, loaded_at=loaded_at, profiles=known)
        parts.append(r.data)
        rejects.append(r.rejects.select("source_file", "line", "reason"))
    if True in kinds:
        r = read_excel(spark, _with_content(spark, books), sheet=sheet, header_row=header_row, skip_rows=skip_rows,
                       date_columns=date_columns, root=root, loaded_at=loaded_at)
        parts.append(r.data)
        rejects.append(r.rejects.select("source_file", F.lit(None).cast("string").alias("line"),
                                        "reason"))
    if not parts:
        empty = spark.createDataFrame([], "source_file string, row_id long, loaded_at timestamp")
        return ReadResult(empty, spark.createDataFrame(
            [], "source_file string, line string, reason string"))
    data = parts[0]
    for p in parts[1:]:
        wide, p = align(data, p, fill=False)     # types inferred apart are widened
        data = (data if wide is None else wide).unionByName(p, allowMissingColumns=True)
    rj = rejects[0]
    for r in rejects[1:]:
        rj = rj.unionByName(r)
    return ReadResult(data, rj)
