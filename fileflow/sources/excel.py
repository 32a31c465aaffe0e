"""Workbook ingestion (S7 one sheet, S8 all sheets) as a Spark job.

``binaryFile`` rows (path, content) are parsed by ``mapInPandas``: each task opens the
workbooks of its partition (a .xlsx/.xlsm file is a zip of XML parts) and emits one row per
sheet row: (path, sheet_idx, sheet, row_idx, cells array<string>, kinds array<string>).
Everything after that — header selection, column mapping, type inference, cleaning — is
Spark SQL. Files are packed into partitions by size (``maxPartitionBytes``), so one task holds
at most about one partition's worth of workbook bytes. Binary ``.xls`` / ``.xlsb`` files are
not decoded; they are returned as rejects with a reason (survey Q10).

Cell kinds: ``s`` text, ``n`` number, ``b`` boolean, ``d`` date/time (ISO text), ``e`` error.
"""

from __future__ import annotations

import datetime as _dt
import io
import re
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fileflow.functions.strings import normalize_names
from fileflow.operators.clean import (add_audit, coerce_dates, drop_empty_rows, null_na_tokens,
                                      strip_strings)
from fileflow.functions.paths import extension, relative_path
from fileflow.session import materialize

ROW_SCHEMA = ("path string, sheet_idx int, sheet string, row_idx long, "
              "cells array<string>, kinds array<string>")
READABLE = [".xlsx", ".xlsm"]
_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
# Built-in number formats that display dates/times.
DATE_FORMAT_IDS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}
_EPOCH = _dt.datetime(1899, 12, 30)
_CHUNK = 5000


def _col_index(ref: str) -> int:
    n = 0
    for ch in ref:
        if ch.isalpha():
            n = n * 26 + (ord(ch.upper()) - 64)
        else:
            break
    return n - 1


def _text(el) -> str:
    return "".join(t.text or "" for t in el.iter(f"{{{_NS['m']}}}t"))


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    try:
        root = ET.fromstring(z.read("xl/styles.xml"))
    except KeyError:
        return set()
    custom = {}
    for nf in root.iterfind("m:numFmts/m:numFmt", _NS):
        code = re.sub(r'"[^"]*"|\[[^\]]*\]', "", nf.get("formatCode", "")).lower()
        custom[int(nf.get("numFmtId"))] = bool(re.search(r"[ymdhs]", code))
    out = set()
    for i, xf in enumerate(root.iterfind("m:cellXfs/m:xf", _NS)):
        fid = int(xf.get("numFmtId", "0"))
        if fid in DATE_FORMAT_IDS or custom.get(fid):
            out.add(i)
    return out


def _number_text(v: str) -> str:
    try:
        f = float(v)
    except ValueError:
        return v
    if f.is_integer() and "e" not in v.lower() and abs(f) < 2 ** 63:
        return str(int(f))
    return repr(f)


def _serial_to_iso(v: str) -> str | None:
    try:
        d = _EPOCH + _dt.timedelta(days=float(v))
    except (ValueError, OverflowError):
        return None
    d = d.replace(microsecond=round(d.microsecond / 1000) * 1000 % 1_000_000)
    return d.isoformat(sep=" ")


def iter_workbook(data: bytes):
    """Yield (sheet_idx, sheet_name, row_idx, cells, kinds) for every non-empty sheet row."""
    z = zipfile.ZipFile(io.BytesIO(data))
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    targets = {r.get("Id"): r.get("Target") for r in rels}
    shared: list[str] = []
    if "xl/sharedStrings.xml" in z.namelist():
        shared = [_text(si) for si in ET.fromstring(z.read("xl/sharedStrings.xml"))
                  .iterfind("m:si", _NS)]
    dates = _date_styles(z)
    for si, sh in enumerate(wb.iterfind("m:sheets/m:sheet", _NS)):
        target = targets.get(sh.get(_REL), "")
        part = target.lstrip("/") if target.startswith("/") else "xl/" + target
        with z.open(part) as fh:
            for _, row in ET.iterparse(fh):
                if row.tag != f"{{{_NS['m']}}}row":
                    continue
                cells: dict[int, tuple[str | None, str]] = {}
                for ci, c in enumerate(row.iterfind("m:c", _NS)):
                    idx = _col_index(c.get("r")) if c.get("r") else ci
                    t = c.get("t", "n")
                    v = c.find("m:v", _NS)
                    vt = v.text if v is not None else None
                    if t == "s" and vt is not None:
                        cells[idx] = (shared[int(vt)], "s")
                    elif t == "inlineStr":
                        is_ = c.find("m:is", _NS)
                        cells[idx] = (_text(is_) if is_ is not None else None, "s")
                    elif t in ("str", "s"):
                        cells[idx] = (vt, "s")
                    elif t == "b":
                        cells[idx] = (None if vt is None else ("true" if vt == "1" else "false"), "b")
                    elif t == "e":
                        cells[idx] = (None, "e")
                    elif t == "d":
                        cells[idx] = (vt.replace("T", " ") if vt else None, "d")
                    elif vt is not None:
                        if int(c.get("s", "0")) in dates:
                            cells[idx] = (_serial_to_iso(vt), "d")
                        else:
                            cells[idx] = (_number_text(vt), "n")
                r = int(row.get("r")) - 1 if row.get("r") else None
                row.clear()
                if not cells:
                    continue
                width = max(cells) + 1
                yield (si, sh.get("name"), r, [cells.get(i, (None, ""))[0] for i in range(width)],
                       [cells.get(i, (None, ""))[1] for i in range(width)])


def _explode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    cols = ["path", "sheet_idx", "sheet", "row_idx", "cells", "kinds"]
    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["content"]):
            buf = []
            seq = 0
            for si, name, r, cells, kinds in iter_workbook(bytes(content)):
                buf.append((path, si, name, r if r is not None else seq, cells, kinds))
                seq += 1
                if len(buf) >= _CHUNK:
                    yield pd.DataFrame(buf, columns=cols)
                    buf = []
            if buf:
                yield pd.DataFrame(buf, columns=cols)


def sheet_rows(files: DataFrame) -> DataFrame:
    """All sheet rows of the workbooks in ``files`` (columns ``path``, ``content``)."""
    return files.select("path", "content").mapInPandas(_explode, ROW_SCHEMA)


@dataclass
class ExcelResult:
    data: DataFrame
    rejects: DataFrame


def _infer(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    from fileflow.sources.csv import infer_types
    ts_cols = [c for c, k in kinds.items() if k == "d"]
    out = df.select(*[F.to_timestamp(F.col(f"`{c}`")).alias(c) if c in ts_cols
                      else F.col(f"`{c}`") for c in df.columns])
    return infer_types(out, exclude=tuple(["_file", "_sheet", "_row"] + ts_cols))


def read_excel(spark: SparkSession, files: DataFrame | str | list[str], *,
               sheet: int | str | None = 0, header_row: int = 0, skip_rows: int = 0,
               date_columns: list[str] | tuple[str, ...] = (), root: str | None = None,
               loaded_at=None) -> ExcelResult:
    """Read workbooks into one cleaned DataFrame (S7); ``sheet=None`` reads every sheet.

    ``sheet``: 0-based index or name. The header is physical row ``skip_rows + header_row``
    (0-based); data rows follow it. With ``sheet=None`` the reference ignores header_row,
    skip_rows and date_columns, and so do we. Output carries ``sheet`` when all sheets are
    read, plus ``source_file``, ``row_id`` (0-based data row within the sheet, after empty
    rows are dropped) and ``loaded_at``.
    """
    if not isinstance(files, DataFrame):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true") \
            .load(files if isinstance(files, list) else [files])
    files = files.withColumn("_ext", extension("path"))
    rejects = files.filter(~F.col("_ext").isin(READABLE)).select(
        F.col("path").alias("source_file"),
        F.lit("binary workbook format not supported").alias("reason"))
    # parse once: the sheet rows are written to the shared checkpoint folder, so the header
    # job and the main job do not parse twice
    rows = materialize(sheet_rows(files.filter(F.col("_ext").isin(READABLE))), "sheet-rows")
    all_sheets = sheet is None
    if all_sheets:
        header_row, skip_rows, date_columns = 0, 0, ()
    elif isinstance(sheet, int):
        rows = rows.filter(F.col("sheet_idx") == sheet)
    else:
        rows = rows.filter(F.col("sheet") == sheet)
    if not all_sheets:
        # a workbook without that sheet, or with nothing in it, is reported
        rejects = rejects.unionByName(
            files.filter(F.col("_ext").isin(READABLE)).select("path")
            .join(rows.select("path").distinct(), "path", "left_anti")
            .select(F.col("path").alias("source_file"),
                    F.lit(f"no rows in sheet {sheet!r}").alias("reason")))
    # header = first non-empty row at or after the header position in each sheet
    hdr_pos = skip_rows + header_row
    rows = rows.filter(F.col("row_idx") >= hdr_pos)
    firsts = rows.groupBy("path", "sheet_idx").agg(F.min("row_idx").alias("_h"))
    tagged = rows.join(firsts, ["path", "sheet_idx"])
    headers = tagged.filter(F.col("row_idx") == F.col("_h")) \
        .select("path", "sheet_idx", F.to_json("cells").alias("_layout"),
                F.col("cells").alias("_header"))
    data = tagged.filter(F.col("row_idx") > F.col("_h")) \
        .join(headers.select("path", "sheet_idx", "_layout"), ["path", "sheet_idx"])
    # distinct header layouts are few (metadata); each output column picks its cell index
    # from a literal layout -> index map, so all layouts share ONE projection (no unions)
    layouts = headers.select("_layout", "_header").distinct().collect()
    if not layouts:
        empty = spark.createDataFrame([], "source_file string, row_id long, loaded_at timestamp")
        return ExcelResult(empty, _named(rejects, root))
    positions: dict[str, dict[str, int]] = {}
    for lay in layouts:
        for i, n in enumerate(normalize_names(list(lay._header))):
            positions.setdefault(n, {})[lay._layout] = i
    cols, kind_cols = [], []
    for name, where in positions.items():
        idx = F.try_element_at(F.create_map(*[x for k, v in where.items()
                                          for x in (F.lit(k), F.lit(v + 1))]), F.col("_layout"))
        cols.append(F.try_element_at(F.col("cells"), idx).alias(name))
        kind_cols.append(F.try_element_at(F.col("kinds"), idx).alias(name))
    base = data.select(F.col("path").alias("_file"), F.col("sheet").alias("_sheet"),
                       F.col("row_idx").alias("_row"), "cells", "kinds", "_layout")
    body = base.select("_file", "_sheet", "_row", *cols)
    data_cols = list(positions)
    kinds = _column_kinds(base.select(*kind_cols), data_cols)
    body = null_na_tokens(body)
    body = drop_empty_rows(body, ignore=("_file", "_sheet", "_row"))
    body = _infer(body, kinds)
    body = strip_strings(body, ignore=("_file", "_sheet"))
    body = coerce_dates(body, list(date_columns))
    from pyspark.sql import Window
    w = Window.partitionBy("_file", "_sheet").orderBy("_row")
    body = body.withColumn("row_id", (F.row_number().over(w) - 1).cast("long"))
    src = relative_path("_file", root) if root else F.col("_file")
    body = add_audit(body, src, loaded_at)
    if all_sheets:
        body = body.withColumnRenamed("_sheet", "sheet")
    return ExcelResult(body.drop("_file", "_sheet", "_row"), _named(rejects, root))


def _named(rejects: DataFrame, root: str | None) -> DataFrame:
    if root is None:
        return rejects
    return rejects.withColumn("source_file", relative_path("source_file", root))


def _column_kinds(kinds_df: DataFrame, cols: list[str]) -> dict[str, str]:
    """'d' when every typed cell of a column is a date; decided in one aggregate pass."""
    if not cols:
        return {}
    aggs = []
    for i, c in enumerate(cols):
        k = F.col(f"`{c}`")
        typed = k.isNotNull() & (k != "")
        aggs += [F.count_if(typed).alias(f"n{i}"), F.count_if(typed & (k == "d")).alias(f"d{i}")]
    r = kinds_df.agg(*aggs).first()
    return {c: ("d" if r[f"n{i}"] and r[f"n{i}"] == r[f"d{i}"] else "") for i, c in enumerate(cols)}
