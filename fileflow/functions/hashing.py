"""Content hashes (md5 / sha-256) as column expressions; identical to hashlib hex digests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_hex(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.md5(col)


def sha256_hex(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.sha2(col, 256)
