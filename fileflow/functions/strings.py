"""String expressions: header normalisation, Unicode strip, NA tokens."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text tokens that a CSV read treats as missing (pandas' default NA list),
# matched after decoding and before stripping. Kept as plain text in natural order.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Unicode whitespace (Java's (?U)\s) plus the four ASCII separators that Python's
# str.isspace() also counts as blank.
_WS = r"[\s\x1c-\x1f]"
_STRIP_RE = rf"(?U)^{_WS}+|{_WS}+$"


def unicode_strip(c: Column | str) -> Column:
    """Strip leading/trailing Unicode whitespace (P3). ``trim`` only removes blanks."""
    col = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(col, _STRIP_RE, "")


def na_to_null(c: Column | str, tokens: list[str] | None = None) -> Column:
    """Map NA tokens (exact match) to NULL, before stripping (survey Q7d)."""
    col = F.col(c) if isinstance(c, str) else c
    toks = NA_TOKENS if tokens is None else tokens
    return F.when(col.isin(toks), F.lit(None).cast("string")).otherwise(col)


def normalize_name(name: object) -> str:
    """One header: strip -> lower -> runs of blanks, '-' or '/' to '_' -> drop non-word chars.

    Python's ``re`` is Unicode-aware, so accented letters survive.
    """
    s = "" if name is None else str(name)
    s = s.strip().lower()
    s = re.sub(r"[\s\-/]+", "_", s)
    return re.sub(r"[^\w]", "", s)


def normalize_names(names: list[object]) -> list[str]:
    """Normalise a whole header (P1) with the survey Q3 rules for empties and duplicates.

    ``''`` becomes ``col_<i>`` (0-based position); a later duplicate gets ``_2``, ``_3``...
    Runs on the driver over column names only (metadata, no data).
    """
    out: list[str] = []
    seen: dict[str, int] = {}
    taken = set()
    for i, raw in enumerate(names):
        base = normalize_name(raw) or f"col_{i}"
        name = base
        if name in taken:
            k = seen.get(base, 1)
            while True:
                k += 1
                name = f"{base}_{k}"
                if name not in taken:
                    break
            seen[base] = k
        taken.add(name)
        out.append(name)
    return out
