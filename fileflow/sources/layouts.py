"""CSV files of any number of header layouts in one plan.

The records of all files come from one scan (``sources.ranges``) and are cut into arrays of cells
by one expression. A layout is (delimiter, header); the table of layouts says for each at which
cell every column of the union stands. Records meet their layout by joins, so the plan has one
expression for each column of the result and none for a layout. Only the distinct column names,
which are the result's schema, reach the driver.

Defined cases: a record with fewer cells than its header is padded with NULLs; one with more is a
reject; an empty cell is NULL, an empty quoted one is empty text; a quote that does not open a
cell, or whose cell goes on behind it, is text; a header of no text is one column ``col_0``.
"""

from __future__ import annotations

import csv as _pycsv
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fileflow.functions.strings import normalize_names
from fileflow.operators.clean import BLOCK_COL, FILE_COL
from fileflow.session import materialize
from fileflow.sources.profile import QUOTED

MAX_BROADCAST_FILES = 500_000          # rows of two short texts
MAX_BROADCAST_CELLS = 4_000_000        # positions (4 bytes) in the table of layouts


def parse_header(line: str | None, delimiter: str) -> list[str]:
    """Header fields of one line (quote-aware)."""
    return next(_pycsv.reader(io.StringIO(line), delimiter=delimiter)) if line else []


def cells(record: Column, delimiter: Column) -> Column:
    """The cells of one record as an array of texts."""
    d = F.concat(F.lit(r"\Q"), delimiter, F.lit(r"\E"))
    pattern = F.concat(d, F.lit(f"({QUOTED}(?="), d, F.lit(r"|\z)|[^"), d, F.lit("]*+)"))
    raw = F.regexp_extract_all(F.concat(delimiter, record), pattern, F.lit(1))
    return F.transform(raw, lambda c: F.when(
        c.rlike(rf"\A{QUOTED}\z"),
        F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"')))
        .when(c != "", c))


def _names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        heads = zip(b.column(1).to_pylist(), b.column(2).to_pylist())
        names = [normalize_names(parse_header(line, d) or [""]) for d, line in heads]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), b.column(3), pa.array(names, pa.list_(pa.string()))],
            ["id", "delimiter", "path", "names"])


def layout_table(files: DataFrame, layout_id: Column) -> tuple[DataFrame, list[str]]:
    """((id, delimiter, width, at), columns): ``at`` gives for each of the columns the number of
    its cell, 0 where the layout has no such column. Columns stand in the order of the first
    file that has them."""
    heads = files.groupBy(layout_id.alias("id"), "delimiter", "header_line") \
        .agg(F.min("path").alias("path"))
    heads = materialize(heads.select("id", "delimiter", "header_line", "path").mapInArrow(
        _names, "id string, delimiter string, path string, names array<string>"), "csv-layouts")
    order = heads.select("path", F.posexplode("names").alias("pos", "name")) \
        .groupBy("name").agg(F.min(F.struct("path", "pos")).alias("first")).orderBy("first")
    columns = [r.name for r in order.select("name").collect()]
    at = F.transform(F.array(*[F.lit(c) for c in columns]),
                     lambda c: F.array_position("names", c).cast("int"))
    return heads.select("id", "delimiter", F.size("names").alias("width"), at.alias("at")), columns


def read_layouts(records: DataFrame, files: DataFrame, layout_id: Column,
                 source_id: Column) -> tuple[DataFrame, DataFrame, int]:
    """(rows, rejects, layouts) of records (path, block, record) of files (path, delimiter,
    header_line): all columns as text, with the file's id and the block."""
    table, columns = layout_table(files, layout_id)
    table = materialize(table, "csv-places")
    layouts = table.count()
    of_file = materialize(files.select("path", layout_id.alias("id")), "csv-of-file")
    small = (of_file.count() <= MAX_BROADCAST_FILES
             and layouts * len(columns) <= MAX_BROADCAST_CELLS)
    if small:
        rows = records.join(F.broadcast(of_file), "path").join(F.broadcast(table), "id")
    else:
        # a shuffled join mixes the records of a block: they are put in order again
        rows = records.withColumn("_ord", F.monotonically_increasing_id()) \
            .join(of_file, "path").join(table, "id") \
            .repartition("path", "block").sortWithinPartitions("path", "block", "_ord")
    rows = rows.withColumn("cells", cells(F.col("record"), F.col("delimiter")))
    # filters would be pushed below this projection and cut the record again for every column
    # they name; they are not pushed below a row number
    rows = rows.select(
        source_id.alias(FILE_COL), F.col("block").alias(BLOCK_COL), "record",
        F.transform("at", lambda p: F.get("cells", p - 1)).alias("_v"),
        (F.size("cells") > F.col("width")).alias("long"),
        F.monotonically_increasing_id().alias("_seq"))
    rejects = rows.where("long").select(FILE_COL, F.col("record").alias("line"),
                                        F.lit("more fields than the header").alias("reason"))
    good = rows.where("not long and _seq >= 0")
    good = good.select(*[F.col("_v")[i].alias(c) for i, c in enumerate(columns)],
                       FILE_COL, BLOCK_COL)
    return good, rejects, layouts
