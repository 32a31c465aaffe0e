"""Per-file profile: encoding (S5), delimiter (S6) and header line (survey Q7-Q9).

One Spark job over rows that carry ``content``, built-in functions only. The whole content is
examined: bytes far into a file decide its encoding, and a quoted line break anywhere decides
that its records must be read across lines. The result has one row per file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Delimiter candidates, in tie-break order.
DELIMITERS = [",", ";", "\t", "|"]
FALLBACK_ENCODING = "windows-1252"
#: A quoted section; doubled quotes stand for one. Possessive: no recursion on long texts.
QUOTED = r'"(?:[^"]++|"")*+"'
FIRST_RECORD = r'^((?:[^"\r\n]++|"(?:[^"]++|"")*+")*+)'


def detect_encoding(content: Column, fallback: str = FALLBACK_ENCODING) -> Column:
    """BOM -> strict UTF-8 over all bytes -> ``fallback`` single-byte charset (survey Q8)."""
    b3 = F.hex(F.substring(content, 1, 3))
    b2 = F.hex(F.substring(content, 1, 2))
    return (F.when(b3 == "EFBBBF", F.lit("UTF-8"))
            .when(b2 == "FFFE", F.lit("UTF-16LE"))
            .when(b2 == "FEFF", F.lit("UTF-16BE"))
            .when(F.is_valid_utf8(content.cast("string")), F.lit("UTF-8"))
            .otherwise(F.lit(fallback)))


def decoded(content: Column, encoding: Column, fallback: str = FALLBACK_ENCODING) -> Column:
    """The whole text without its byte order mark; broken bytes become U+FFFD."""
    text = (F.when(encoding == "UTF-8", F.make_valid_utf8(content.cast("string")))
            .when(encoding == "UTF-16LE", F.decode(content, "UTF-16LE"))
            .when(encoding == "UTF-16BE", F.decode(content, "UTF-16BE")))
    for name in dict.fromkeys([fallback, "ISO-8859-1"]):
        text = text.when(encoding == name, F.decode(content, name))
    return F.regexp_replace(text, r"^\x{FEFF}", "")


def detect_delimiter(line: Column, candidates: list[str] = DELIMITERS) -> Column:
    """Candidate occurring most often in the header outside quotes; ties -> list order; none ->
    ',' (survey Q9: a single-column file keeps its header intact)."""
    bare = F.regexp_replace(line, QUOTED, "")
    counts = [(F.length(bare) - F.length(F.replace(bare, F.lit(d), F.lit("")))) for d in candidates]
    best = F.greatest(*counts)
    out = F.lit(",")
    for d, c in reversed(list(zip(candidates, counts))):
        out = F.when((c == best) & (best > 0), F.lit(d)).otherwise(out)
    return out


PROFILE_COLUMNS = ["path", "size_bytes", "encoding", "has_bom", "header_line", "multi_line",
                   "delimiter"]


def with_profile(df: DataFrame, encoding: str | None = None, delimiter: str | None = None,
                 fallback: str = FALLBACK_ENCODING) -> DataFrame:
    """Add the profile columns to rows that carry ``content`` (kept alongside, so landing can
    compute md5 and profile while the bytes are read once).

    ``multi_line``: after taking out quoted sections without line breaks a quote is left."""
    enc = F.lit(encoding) if encoding else detect_encoding(F.col("content"), fallback)
    out = df.select("*", F.length("content").cast("long").alias("size_bytes"),
                    enc.alias("encoding"),
                    F.hex(F.substring("content", 1, 3)).startswith("EFBBBF").alias("has_bom"))
    out = out.withColumn("_text", decoded(F.col("content"), F.col("encoding"),
                                          encoding or fallback))
    out = out.select("*", F.regexp_extract("_text", FIRST_RECORD, 1).alias("header_line"),
                     F.contains(F.regexp_replace("_text", r'"[^"\r\n]*+"', ""), F.lit('"'))
                     .alias("multi_line")).drop("_text")
    return out.withColumn("delimiter", F.lit(delimiter) if delimiter else
                          detect_delimiter(F.col("header_line")))


def profile_content(df: DataFrame, encoding: str | None = None, delimiter: str | None = None,
                    fallback: str = FALLBACK_ENCODING) -> DataFrame:
    """Profile rows with ``path`` and ``content`` (binaryFile shape, or a bronze table)."""
    return with_profile(df.select("path", "content"), encoding, delimiter, fallback) \
        .select(*PROFILE_COLUMNS)


def profile(spark: SparkSession, paths: list[str], encoding: str | None = None,
            delimiter: str | None = None, fallback: str = FALLBACK_ENCODING) -> DataFrame:
    raw = spark.read.format("binaryFile").load(paths)
    return profile_content(raw, encoding, delimiter, fallback)
