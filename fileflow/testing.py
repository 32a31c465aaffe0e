"""Fixture builders shared by tests and the driver queries.

``workbook_bytes`` writes a minimal .xlsx (inline strings, numbers, booleans, date cells with
a date style) so workbook ingestion can be exercised without any spreadsheet library.
"""

from __future__ import annotations

import datetime as _dt
import io
import zipfile
from xml.sax.saxutils import escape

_EPOCH = _dt.datetime(1899, 12, 30)


def _col(i: int) -> str:
    s = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        s = chr(65 + r) + s
    return s


def _cell(ref: str, v) -> str:
    if v is None:
        return ""
    if isinstance(v, bool):
        return f'<c r="{ref}" t="b"><v>{int(v)}</v></c>'
    if isinstance(v, (_dt.datetime, _dt.date)):
        if not isinstance(v, _dt.datetime):
            v = _dt.datetime(v.year, v.month, v.day)
        serial = (v - _EPOCH).total_seconds() / 86400.0
        return f'<c r="{ref}" s="1"><v>{serial!r}</v></c>'
    if isinstance(v, (int, float)):
        return f'<c r="{ref}"><v>{v!r}</v></c>'
    return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>'


def _sheet_xml(rows: list[list]) -> str:
    out = []
    for r, row in enumerate(rows):
        if row is None:
            continue
        cells = "".join(_cell(f"{_col(c)}{r + 1}", v) for c, v in enumerate(row))
        out.append(f'<row r="{r + 1}">{cells}</row>')
    return ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
            '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
            f'<sheetData>{"".join(out)}</sheetData></worksheet>')


def workbook_bytes(sheets: list[tuple[str, list[list]]]) -> bytes:
    """An .xlsx with the given sheets; ``rows[i] = None`` leaves sheet row i empty."""
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    pkg = "http://schemas.openxmlformats.org/package/2006/relationships"
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        over = "".join(
            f'<Override PartName="/xl/worksheets/sheet{i + 1}.xml" ContentType="application/'
            f'vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
            for i in range(len(sheets)))
        z.writestr("[Content_Types].xml",
                   '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.'
                   'openxmlformats.org/package/2006/content-types"><Default Extension="rels" '
                   'ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
                   '<Default Extension="xml" ContentType="application/xml"/><Override '
                   'PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-'
                   'officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/'
                   'styles.xml" ContentType="application/vnd.openxmlformats-officedocument.'
                   f'spreadsheetml.styles+xml"/>{over}</Types>')
        z.writestr("_rels/.rels",
                   f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="{pkg}">'
                   f'<Relationship Id="rId1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/>'
                   '</Relationships>')
        sh = "".join(f'<sheet name="{escape(n)}" sheetId="{i + 1}" r:id="rId{i + 1}"/>'
                     for i, (n, _) in enumerate(sheets))
        z.writestr("xl/workbook.xml",
                   f'<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="{main}" '
                   f'xmlns:r="{rel}"><sheets>{sh}</sheets></workbook>')
        rels = "".join(f'<Relationship Id="rId{i + 1}" Type="{rel}/worksheet" '
                       f'Target="worksheets/sheet{i + 1}.xml"/>' for i in range(len(sheets)))
        rels += (f'<Relationship Id="rId{len(sheets) + 1}" Type="{rel}/styles" '
                 'Target="styles.xml"/>')
        z.writestr("xl/_rels/workbook.xml.rels",
                   f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="{pkg}">'
                   f'{rels}</Relationships>')
        z.writestr("xl/styles.xml",
                   f'<?xml version="1.0" encoding="UTF-8"?><styleSheet xmlns="{main}">'
                   '<cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="22" applyNumberFormat="1"/>'
                   '</cellXfs></styleSheet>')
        for i, (_, rows) in enumerate(sheets):
            z.writestr(f"xl/worksheets/sheet{i + 1}.xml", _sheet_xml(rows))
    return buf.getvalue()


# --- Spark-side fixture writers (run on executors, write to the shared scratch folder) ------

def write_csv_with_header_rows(df, path: str, header: list[str], sep: str = ",",
                               line_col: str = "line") -> None:
    """Write ``df[line_col]`` (pre-joined text lines) as text files whose first line is
    ``header`` joined by ``sep`` — lets tests build deliberately ragged CSV lines.

    The header row is emitted at the head of every partition by ``mapInPandas`` (no shuffle,
    so the order reaches the text writer unchanged)."""
    import pandas as pd

    head = sep.join(header)

    def gen(batches):
        first = True
        for pdf in batches:
            if first:
                yield pd.DataFrame({"value": [head]})
                first = False
            yield pd.DataFrame({"value": pdf[line_col].astype(str)})

    df.select(line_col).mapInPandas(gen, "value string").write.mode("overwrite").text(path)
