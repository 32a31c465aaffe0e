"""File-name parts of a path column (P6): name, extension, parent, keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def metadata_path() -> Column:
    """``_metadata.file_path`` decoded to the plain form ``binaryFile`` reports.

    The metadata column is a percent-encoded URI ('a b.csv' -> 'a%20b.csv'); '+' is literal
    in a URI path, so it is protected before URL-decoding (which would read it as a space)."""
    raw = F.col("_metadata.file_path")
    return F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))


def file_name(path: Column | str) -> Column:
    """Last path segment."""
    return F.element_at(F.split(_c(path), "/"), -1)


def extension(path: Column | str) -> Column:
    """Lower-cased extension with the dot (``.csv``), or '' when the name has none."""
    ext = F.regexp_extract(file_name(path), r"(\.[^./]*)$", 1)
    return F.lower(ext)


def base_name(path: Column | str) -> Column:
    """Name without its last extension."""
    return F.regexp_replace(file_name(path), r"\.[^./]*$", "")


def parent_path(path: Column | str) -> Column:
    return F.regexp_replace(_c(path), r"/[^/]*$", "")


def relative_path(path: Column | str, root: str) -> Column:
    """Path relative to ``root`` (survey Q14: keys keep folders and extension)."""
    r = root.rstrip("/") + "/"
    p = _c(path)
    # binaryFile reports file:/ URIs; accept a root given with or without the scheme
    p = F.regexp_replace(p, r"^file:(//)?", "")
    r_plain = r[5:] if r.startswith("file:") else r
    r_plain = r_plain.lstrip("/")
    p = F.regexp_replace(p, r"^/+", "")
    return F.when(F.startswith(p, F.lit(r_plain)), F.substring(p, len(r_plain) + 1, 1 << 30)) \
        .otherwise(p)


def bronze_key(run_date: Column | str, rel_path: Column | str) -> Column:
    return F.concat_ws("/", _c(run_date), _c(rel_path))


def silver_key(run_date: Column | str, rel_path: Column | str) -> Column:
    return F.concat_ws("/", _c(run_date), F.concat(_c(rel_path), F.lit(".parquet")))
