"""CSV ingestion (S4) with profiling (S5, S6), header-grouped reads (Q7), bad-line rejects
(Q7b), NA tokens (Q7d), type inference (Q6) and the cleaning chain (P1-P5, P7); export (S21).

Plan
----
1. ``profile`` job: one row per file (encoding, delimiter, header record, line breaks in quotes).
2. The files' bytes, from the folder or from bronze, are decoded and written once as UTF-8 text
   under the shared folder, partitioned by (layout, file). A layout is (delimiter, header,
   multi_line); only the distinct layouts reach the driver. Each layout is one
   ``spark.read.csv`` over its folder with a declared all-string schema, so a file never
   borrows another file's header, and files without quoted line breaks are read split-wise
   whatever their encoding was.
3. Layouts are unioned by normalised column name; NA tokens become NULL; fully empty rows are
   dropped. The parsed rows are written once; row ids (per file, no single-task sort) and type
   inference (``operators.lattice``; ``schema`` skips it) both read them.
4. Strings are stripped, listed date columns coerced, audit columns added.

Files given in chunks skip step 2: ``sources.ranges`` finds their records (quoted line breaks
included) by a scan of quote states, and ``from_csv`` parses them, so no row holds a file.
Files of more than MAX_LAYOUT_READS layouts go the same way, but are cut into arrays of cells in
one plan for all layouts (``sources.layouts``).

Quotes follow the usual rule: a doubled quote inside quotes is one quote; a backslash is text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from fileflow.functions.paths import relative_path
from fileflow.operators import lattice
from fileflow.operators.clean import (BLOCK_COL, FILE_COL, add_audit, coerce_dates,
                                      drop_empty_rows, null_na_tokens, split_offsets,
                                      strip_strings)
from fileflow.functions.strings import normalize_names
from fileflow.session import materialize, scratch_path
from fileflow.sources.chunks import chunked, open_fs, read_chunks
from fileflow.sources.layouts import parse_header, read_layouts
from fileflow.sources.profile import FALLBACK_ENCODING, QUOTED, decoded, with_profile
from fileflow.sources.ranges import profile_chunks, records

CORRUPT = "_corrupt_record"
LAYOUT, SOURCE = "_g", "_src"
MAX_BROADCAST_FILES = 500_000
#: A folder with a larger file is read in ranges; up to here a file is one row. A task that decodes
#: and profiles a row needs about ten times its bytes.
WHOLE_MAX = 8 << 20
#: UTF-16, which has no ranges, stays one row up to here, and so far line breaks inside quotes are
#: what the plain reader makes of them.
PLAIN_MAX = 256 << 20
#: More layouts than this are read by one plan (``sources.layouts``), up to here each by its own.
MAX_LAYOUT_READS = 16


@dataclass
class CsvResult:
    data: DataFrame
    rejects: DataFrame
    groups: int


def as_utf8(content):
    """UTF-16 contents (by byte order mark) as UTF-8; others as they are."""
    mark = F.hex(F.substring(content, 1, 2))
    return F.when(mark == "FFFE", F.encode(decoded(content, F.lit("UTF-16LE")), "UTF-8")) \
        .when(mark == "FEFF", F.encode(decoded(content, F.lit("UTF-16BE")), "UTF-8")) \
        .otherwise(content)


def _utf16(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The paths whose file begins with a byte order mark of UTF-16."""
    for b in batches:
        found = []
        for path in b.column(0).to_pylist():
            system, name = open_fs(path)
            with system.open_input_file(name) as fh:
                if fh.read_at(2, 0) in (b"\xff\xfe", b"\xfe\xff"):
                    found.append(path)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["path"])


def folder_chunks(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """The files of a folder (``files``: their listing) as chunk rows: larger ones by byte ranges."""
    length = F.col("length")
    wide = files.where((length > WHOLE_MAX) & (length <= PLAIN_MAX)).select("path")
    wide = materialize(wide.mapInArrow(_utf16, "path string"), "csv-utf16")
    rows = read_chunks(spark, folder, WHOLE_MAX, min_bytes=WHOLE_MAX)
    small = files.where(length <= WHOLE_MAX)
    if not wide.isEmpty():
        rows = rows.join(F.broadcast(wide), "path", "left_anti").select(*rows.columns)
        small = small.unionByName(files.where(length <= PLAIN_MAX).join(
            F.broadcast(wide), "path", "left_semi").select(*files.columns))
    return rows.unionByName(chunked(small.withColumn("content", as_utf8(F.col("content")))))


def stage_text(files: DataFrame, fallback: str = FALLBACK_ENCODING) -> str:
    """Write the decoded text of every file (``path``, ``content``, profile columns) as UTF-8
    under one scratch folder, in partitions (layout, file); returns the folder."""
    path = scratch_path(files.sparkSession, "csv-text")
    files.select(decoded(F.col("content"), F.col("encoding"), fallback).alias("value"),
                 _layout_id().alias(LAYOUT), _source_id().alias(SOURCE)) \
        .write.partitionBy(LAYOUT, SOURCE).text(path)
    return path


def _layout_id():
    return F.concat(F.lit("g"), F.substring(F.sha2(F.concat_ws(
        "\u0001", "delimiter", F.col("multi_line").cast("string"), "header_line"), 256), 1, 32))


def _source_id():
    # a hash, since an escaped path can be longer than a folder name may be
    return F.concat(F.lit("f"), F.substring(F.sha2("path", 256), 1, 40))


def too_long(whole, delimiter: str, n: int):
    """More fields than ``n``: separators outside quoted fields are counted."""
    sep = "\\" + delimiter if delimiter in "|" else delimiter
    bare = F.regexp_replace(whole, rf"(?<=^|{sep}){QUOTED}(?={sep}|$)", "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(delimiter), F.lit(""))) + 1 > n


#: Options of both readers: quotes are doubled, a backslash is text.
_OPTIONS = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def _columns(header_line: str, delimiter: str) -> tuple[list[str], list[str]]:
    """(raw names, column names of the all-string schema)."""
    raw_names = parse_header(header_line, delimiter)
    return raw_names, [f"_c{i}" for i in range(max(len(raw_names), 1))]


def _read_layout(spark: SparkSession, stage: str, layout: str, delimiter: str, header_line: str,
                 multi_line: bool):
    raw_names, raw_cols = _columns(header_line, delimiter)
    schema = StructType([StructField(c, StringType(), True) for c in
                         [*raw_cols, CORRUPT, SOURCE]])
    df = (spark.read.schema(schema).option("basePath", f"{stage}/{LAYOUT}={layout}")
          .options(**_OPTIONS).option("header", "true").option("sep", delimiter)
          .option("encoding", "UTF-8").option("maxColumns", str(max(20480, 2 * len(raw_cols))))
          .option("multiLine", "true" if multi_line else "false")
          .option("enforceSchema", "true")
          .csv(f"{stage}/{LAYOUT}={layout}"))
    df = df.select(*raw_cols, CORRUPT, F.col(SOURCE).alias(FILE_COL),
                   F.col("_metadata.file_block_start").alias(BLOCK_COL))
    return _good_and_rejects(df, raw_names, raw_cols, delimiter)


def _read_records(records: DataFrame, delimiter: str, header_line: str):
    """The same from rows (path, block, record): one text per record."""
    raw_names, raw_cols = _columns(header_line, delimiter)
    schema = ", ".join(f"`{c}` string" for c in [*raw_cols, CORRUPT])
    options = {**_OPTIONS, "sep": delimiter, "maxColumns": str(max(20480, 2 * len(raw_cols)))}
    # by a generator, which filters on the fields are not moved below: as a plain column the record
    # would be parsed again for each field that they name
    df = records.select(_source_id().alias(FILE_COL), F.col("block").alias(BLOCK_COL),
                        F.inline(F.array(F.from_csv("record", schema, options))))
    return _good_and_rejects(df.select(*raw_cols, CORRUPT, FILE_COL, BLOCK_COL), raw_names,
                             raw_cols, delimiter)


def _good_and_rejects(df: DataFrame, raw_names: list[str], raw_cols: list[str], delimiter: str):
    # survey Q7b: a line with more fields than the header is dropped (to rejects); a short
    # line is kept and padded with NULLs. The test names every data column (coalesce with the
    # joined row): with column pruning the parser would not flag long lines, and Spark refuses
    # plans that read only the corrupt column (e.g. a bare count).
    whole = F.coalesce(F.col(CORRUPT), F.concat_ws(delimiter, *raw_cols))
    df = df.withColumn("_too_long", F.col(CORRUPT).isNotNull()
                       & too_long(whole, delimiter, len(raw_cols)))
    rejects = df.filter("_too_long").select(F.col(FILE_COL), whole.alias("line"),
                                            F.lit("more fields than the header").alias("reason"))
    good = df.filter(~F.col("_too_long")).drop("_too_long", CORRUPT)
    names = normalize_names(raw_names) if raw_names else ["col_0"]
    return good.toDF(*names, FILE_COL, BLOCK_COL), rejects


def infer_types(df: DataFrame, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Narrowest type per string column that keeps every value, in ONE aggregate pass (survey
    Q6; ``operators.lattice``). NULLs are ignored; an all-NULL column stays string."""
    cols = [f.name for f in df.schema.fields
            if isinstance(f.dataType, StringType) and f.name not in exclude]
    if not cols:
        return df
    r = df.agg(*lattice.state(cols)).first()
    return lattice.typed(df, {c: lattice.resolve(r, i) for i, c in enumerate(cols)})


def _row_ids_and_types(data: DataFrame, infer: bool = True) -> DataFrame:
    """Row ids per file (P7) and type inference (Q6) from ONE aggregate pass.

    The parsed rows are written once with their ids in task order, so the statistics and the
    main pass see the same rows and the same splits, whatever settings change in between, and
    CSV text is parsed once. The per-split aggregate (one row per input split: first id, row
    count, and per column the state of ``operators.lattice``) is small; global types are the
    states merged; split offsets are a running sum.
    """
    cols = [f.name for f in data.schema.fields
            if isinstance(f.dataType, StringType) and f.name not in (FILE_COL, BLOCK_COL)] \
        if infer else []
    tagged = materialize(data.withColumn("_mid", F.monotonically_increasing_id()), "csv-rows")
    stats, offs = split_offsets(tagged, FILE_COL, BLOCK_COL, lattice.state(cols))
    types: dict[str, str | None] = {}
    if cols:
        r = stats.agg(*lattice.merged(len(cols))).first()
        types = {c: lattice.resolve(r, i) for i, c in enumerate(cols)}
    out = tagged.join(offs, [FILE_COL, BLOCK_COL], "inner")
    out = out.withColumn("row_id", (F.col("_off") + F.col("_mid") - F.col("_m0")).cast("long"))
    return lattice.typed(out.select(*[F.col(f"`{c}`") for c in data.columns], "row_id"), types)


def apply_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Cast to a declared schema by name (no inference pass); absent columns become NULL."""
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            src = F.col(f"`{f.name}`")
            cols.append((F.trim(src).try_cast(f.dataType)
                         if not isinstance(f.dataType, StringType) else src).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    keep = [F.col(c) for c in df.columns if c not in schema.fieldNames() and c.startswith("_")]
    return df.select(*cols, *keep)


def read_csv(spark: SparkSession, paths: list[str] | str | DataFrame, *,
             delimiter: str | None = None, encoding: str | None = None,
             date_columns: list[str] | tuple[str, ...] = (), schema: StructType | None = None,
             na_tokens: list[str] | None = None, root: str | None = None,
             loaded_at=None, fallback_encoding: str = FALLBACK_ENCODING,
             date_formats: list[str] | None = None,
             profiles: bool = False) -> CsvResult:
    """Read, clean and type a set of CSV files into one DataFrame (plus a rejects DataFrame).

    ``paths``: a folder, a list of files, or a DataFrame with ``path`` and ``content`` (e.g. from
    bronze; then those bytes are what is parsed). A DataFrame of chunks (``sources.chunks``: also
    ``size_bytes`` and ``offset``) is parsed in ranges, one file by many tasks. ``source_file`` is the path relative to
    ``root`` when given, else the full path. ``profiles``: set when ``paths`` already carries
    the profile columns computed at landing; then the bytes are read once, by the staging step.
    """
    as_plain = 0
    if isinstance(paths, DataFrame):
        files = paths
        if "content" not in files.columns:
            raise ValueError("a DataFrame of files must carry their content")
    else:
        plist = [paths] if isinstance(paths, str) else list(paths)
        if not plist:
            return _empty(spark)
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true") \
            .load(plist)
        # only the listing is read here; one large file and all of them go by ranges
        if isinstance(paths, str) and (files.agg(F.max("length")).first()[0] or 0) > WHOLE_MAX:
            files = folder_chunks(spark, paths, files)
            as_plain = PLAIN_MAX
    fallback = encoding or fallback_encoding
    in_ranges = "offset" in files.columns
    states = None
    if in_ranges:
        chunks = files.select("path", "size_bytes", "offset", "content")
        files, states = profile_chunks(chunks, encoding, delimiter, fallback_encoding)
        files = materialize(files, "csv-files")
    else:
        if not profiles:
            files = with_profile(files.select("path", "content"), encoding, delimiter,
                                 fallback_encoding)
        files = files.withColumn("reason", F.lit(None).cast("string"))
    # an empty file has no header and no rows: nothing to read
    files = files.filter(F.col("size_bytes") > 0)
    # a file's name as rows show it is made once per file
    src = relative_path("path", root) if root else F.col("path")
    names = materialize(files.select(_source_id().alias(FILE_COL), src.alias("_path")),
                        "csv-names")
    names = F.broadcast(names) if names.count() <= MAX_BROADCAST_FILES else names
    found = files.filter("reason is null").groupBy(
        _layout_id().alias("id"), "delimiter", "header_line", "multi_line") \
        .agg(F.min("path").alias("path")).orderBy("path")
    layouts = found.limit(MAX_LAYOUT_READS + 1).collect()
    many = len(layouts) > MAX_LAYOUT_READS
    if many and not in_ranges:
        text = decoded(F.col("content"), F.col("encoding"), fallback)
        chunks = chunked(files.select("path", F.encode(text, "UTF-8").alias("content")))
        files, states = profile_chunks(chunks, "UTF-8", delimiter, fallback_encoding)
        files, in_ranges = materialize(files, "csv-files"), True
    bad = files.filter("reason is not null").select(
        _source_id().alias(FILE_COL), F.lit(None).cast("string").alias("line"), "reason")
    stage = stage_text(files, fallback) if layouts and not in_ranges else None
    parts, rejects, groups = [], [bad] if in_ranges else [], len(layouts)
    if many:
        mine = files.filter("reason is null")
        good, rej, groups = read_layouts(records(chunks, mine, states, fallback, as_plain), mine,
                                         _layout_id(), _source_id())
        parts, rejects, layouts = [good], [*rejects, rej], []
    for g in layouts:
        if in_ranges:
            mine = files.filter((_layout_id() == g.id) & F.col("reason").isNull())
            good, rej = _read_records(records(chunks, mine, states, fallback, as_plain),
                                      g.delimiter, g.header_line)
        else:
            good, rej = _read_layout(spark, stage, g.id, g.delimiter, g.header_line, g.multi_line)
        parts.append(good)
        rejects.append(rej)
    src = F.col("_path")
    rj = _empty(spark).rejects
    if rejects:
        rj = reduce(DataFrame.unionByName, rejects).join(names, FILE_COL) \
            .select(src.alias("source_file"), "line", "reason")
    if not parts:
        return CsvResult(_empty(spark).data, rj, 0)
    data = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    data = null_na_tokens(data, na_tokens)
    data = drop_empty_rows(data)
    data = _row_ids_and_types(data, infer=schema is None)
    if schema is not None:
        data = apply_schema(data, schema)
    data = strip_strings(data, ignore=(FILE_COL, BLOCK_COL))
    data = coerce_dates(data, list(date_columns), date_formats)
    data = add_audit(data.join(names, FILE_COL), src, loaded_at) \
        .drop(FILE_COL, BLOCK_COL, "_path")
    return CsvResult(data, rj, groups)


def _empty(spark):
    return CsvResult(spark.createDataFrame([], "source_file string, row_id long, "
                                                "loaded_at timestamp"),
                     spark.createDataFrame([], "source_file string, line string, reason string"),
                     0)


def export_csv(df: DataFrame, path: str, mode: str = "overwrite", **options) -> None:
    """Write a (filtered) record set as CSV with a header row (S21): quotes are doubled, and
    blanks around values are kept."""
    w = df.write.mode(mode).option("header", "true").option("escape", '"') \
        .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
    for k, v in options.items():
        w = w.option(k, v)
    w.csv(path)
