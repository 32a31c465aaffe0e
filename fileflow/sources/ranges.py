"""CSV files parsed in byte ranges (S4): one file with quoted line breaks is read by many tasks.

Where a range's first record starts depends on the quotes of everything before it. So:

1. Each chunk is a function from the state at its first byte to the state after its last. The
   state is one of STATES; a quote opens a field only at the field's start, two in a row inside
   stand for one, any other is text. A file's functions, in offset order, are applied one after
   the other (a few bytes per chunk), which gives the state every chunk starts in.
2. From its state each chunk finds the records that begin and end in it. What is left at its
   edges, the head of a record that began earlier and the tail of one that goes on, is joined
   over chunks by (file, record).
3. Records are parsed by ``from_csv`` with the options of the plain reader.

The result does not depend on the chunk size. Line breaks inside quotes stay as they are in the
file (the plain reader turns CR LF into LF there). Encoding is decided over all bytes (byte order mark,
UTF-8 checked across chunk edges, else the fallback); UTF-16 and a header that is longer than the
first chunk are rejected with a reason. Records come in file order inside a chunk's block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fileflow.session import materialize
from fileflow.sources.profile import (FALLBACK_ENCODING, FIRST_RECORD, decoded, detect_delimiter)

#: A record starts here; a field starts here; inside an unquoted field; inside quotes; just after
#: a closing quote; just after a carriage return.
LINE, FIELD, MID, QUOTED, CLOSED, CR = STATES = range(6)
_QUOTE, _LF, _CR = 34, 10, 13
_SCAN = ("path string, size_bytes long, offset long, length long, steps string, head binary, "
         "tail binary, valid boolean")
_RECORDS = "path string, block long, starts boolean, encoding string, record binary"
MAX_BROADCAST = 500_000
#: Records that a Python worker hands back at a time.
OUT_ROWS = 10_000


def accepted(buf: np.ndarray, delimiter: int, state: int) -> tuple[np.ndarray, bool]:
    """Positions of the quotes that open or close a field, and whether the last one opened it."""
    q = np.flatnonzero(buf == _QUOTE)
    before = buf[q - 1]                                  # of position 0: wrong, mended below
    opens = (before == delimiter) | (before == _LF) | (before == _CR)
    again = before == _QUOTE
    if len(q) and q[0] == 0:
        opens[0] = state in (LINE, FIELD, CLOSED, CR)
        again[0] = False
    inside, out, i, span = state == QUOTED, [], 0, 1 << 16
    while i < len(q):
        n = min(span, len(q) - i)
        # suppose all take turns; the first one that may not open is text
        outside = (np.arange(n) & 1) == (1 if inside else 0)
        ok = opens[i:i + n] | again[i:i + n]
        if again[i] and not opens[i] and not inside:
            # right after a quote: it goes on inside only if that one closed the field
            ok[0] = bool(out) and len(out[-1]) > 0 and out[-1][-1] == q[i] - 1
        bad = np.flatnonzero(outside & ~ok)
        k = int(bad[0]) if len(bad) else n
        out.append(q[i:i + k])
        inside ^= bool(k & 1)
        i += k + (k < n)
        span = min(span * 2, 1 << 16) if k == n else max(64, 2 * k)
    return (np.concatenate(out) if out else q[:0]), inside


def end_state(buf: np.ndarray, delimiter: int, quotes: np.ndarray, inside: bool) -> int:
    if inside:
        return QUOTED
    last = int(buf[-1])
    if last == _QUOTE:
        return CLOSED if len(quotes) and quotes[-1] == len(buf) - 1 else MID
    return {_LF: LINE, _CR: CR, delimiter: FIELD}.get(last, MID)


def steps(buf: np.ndarray, delimiter: int) -> str:
    """The end state for each state at the first byte."""
    end = {s: end_state(buf, delimiter, *accepted(buf, delimiter, s)) for s in (LINE, MID, QUOTED)}
    return "".join(str(end[QUOTED if s == QUOTED else MID if s == MID else LINE]) for s in STATES)


def record_starts(buf: np.ndarray, delimiter: int, state: int) -> tuple[np.ndarray, int]:
    """Positions where records start, and the state after the last byte."""
    quotes, inside = accepted(buf, delimiter, state)
    breaks = np.flatnonzero((buf == _LF) | (buf == _CR))
    odd = (np.searchsorted(quotes, breaks) & 1) == 1
    breaks = breaks[odd == (state == QUOTED)]            # those outside quotes
    follow = breaks + 1
    inner = follow < len(buf)
    breaks, follow = breaks[inner], follow[inner]
    follow = follow[(buf[breaks] == _LF) | (buf[follow] != _LF)]
    if state == LINE or state == CR and buf[0] != _LF:
        follow = np.concatenate(([0], follow))
    return follow, end_state(buf, delimiter, quotes, inside)


def utf8_edges(data: bytes, first: bool, last: bool) -> tuple[bytes, bytes, bool]:
    """(continuation bytes at the start, unfinished character at the end, rest is valid)."""
    a = 0
    while not first and a < min(3, len(data)) and data[a] & 0xC0 == 0x80:
        a += 1
    b = len(data)
    if not last:
        for k in range(1, min(3, len(data) - a) + 1):
            c = data[-k]
            if c & 0xC0 != 0x80:
                if c >= 0xC0 and k < (2 if c < 0xE0 else 3 if c < 0xF0 else 4):
                    b = len(data) - k
                break
    try:
        data[a:b].decode("utf-8")
        return data[:a], data[b:], True
    except UnicodeDecodeError:
        return data[:a], data[b:], False


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(b.num_rows):
            path, size, at, delimiter = (b.column(c)[i].as_py() for c in range(4))
            data = b.column(4)[i].as_py()
            head, tail, valid = utf8_edges(data, at == 0, at + len(data) >= size)
            fn = steps(np.frombuffer(data, np.uint8), ord(delimiter))
            yield pa.RecordBatch.from_pylist([{
                "path": path, "size_bytes": size, "offset": at, "length": len(data), "steps": fn,
                "head": head, "tail": tail, "valid": valid}], schema=_SCAN_ARROW)


_SCAN_ARROW = pa.schema([("path", pa.string()), ("size_bytes", pa.int64()), ("offset", pa.int64()),
                         ("length", pa.int64()), ("steps", pa.string()), ("head", pa.binary()),
                         ("tail", pa.binary()), ("valid", pa.bool_())])


def _split(whole: bool):
    """Records that lie in one chunk, or the pieces at chunk edges."""
    def rows(path, block, starts, encoding, record: pa.Array) -> pa.RecordBatch:
        n = len(record)
        return pa.RecordBatch.from_arrays(
            [pa.array([path] * n, pa.string()), pa.array(np.broadcast_to(block, n)),
             pa.array(np.broadcast_to(starts, n)), pa.array([encoding] * n, pa.string()), record],
            ["path", "block", "starts", "encoding", "record"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                path, at, delimiter, state, encoding = (b.column(c)[i].as_py() for c in range(5))
                data = b.column(5)[i].as_buffer()
                buf = np.frombuffer(data, np.uint8)
                first, end = record_starts(buf, ord(delimiter), state)
                closed = end == LINE                      # the last record ends with the chunk
                if whole:
                    cuts = np.concatenate((first, [len(buf)])) if closed else first
                    cuts = (cuts[1:] if at == 0 else cuts).astype(np.int64)      # the header
                    for k in range(0, len(cuts) - 1, OUT_ROWS):
                        some = cuts[k:k + OUT_ROWS + 1]
                        yield rows(path, at, True, encoding, pa.Array.from_buffers(
                            pa.large_binary(), len(some) - 1,
                            [None, pa.py_buffer((some - some[0]).tobytes()),
                             data.slice(int(some[0]), int(some[-1] - some[0]))]).cast(pa.binary()))
                    continue
                head = buf[:first[0]] if len(first) else buf
                if len(head):
                    yield rows(path, at, False, encoding, pa.array([head.tobytes()], pa.binary()))
                if len(first) and not closed and not (at == 0 and len(first) == 1):
                    yield rows(path, at + len(buf) - 1, True, encoding,
                               pa.array([buf[first[-1]:].tobytes()], pa.binary()))
    return run


def _run(chunks: Column) -> Column:
    """States at the start of each of the (offset, steps) in order."""
    return F.aggregate(
        chunks, F.struct(F.lit(LINE).alias("now"), F.expr("cast(array() as array<int>)").alias("all")),
        lambda acc, x: F.struct(
            F.substring(x["steps"], acc["now"] + 1, F.lit(1)).cast("int").alias("now"),
            F.concat(acc["all"], F.array(acc["now"])).alias("all")), lambda acc: acc["all"])


def profile_chunks(chunks: DataFrame, encoding: str | None = None, delimiter: str | None = None,
                   fallback: str = FALLBACK_ENCODING) -> tuple[DataFrame, DataFrame]:
    """((path, delimiter, header_line, encoding, multi_line, reason), (path, offset, state)) for
    files in chunks. ``reason`` is null for a file that can be read."""
    first = chunks.where("offset = 0").withColumn("mark", F.hex(F.substring("content", 1, 2)))
    text = decoded(F.col("content"), F.lit(encoding or "UTF-8"), encoding or fallback)
    header = F.regexp_extract(text, FIRST_RECORD, 1)
    first = first.select(
        "path", "mark", header.alias("header_line"), F.octet_length("content").alias("n"),
        "size_bytes", F.substring("content", 1, F.octet_length(header) + 5).alias("start"))
    first = materialize(first.withColumn("delimiter", F.lit(delimiter) if delimiter else
                                         detect_delimiter(F.col("header_line"))), "csv-heads")
    named = chunks.join(_hint(first.select("path", "delimiter")), "path")
    found = materialize(named.select("path", "size_bytes", "offset", "delimiter", "content")
                        .mapInArrow(_scan, _SCAN), "csv-steps")
    near = W.partitionBy("path").orderBy("offset")
    joint = F.concat("tail", F.coalesce(F.lead("head").over(near), F.lit(b"")))
    edges = found.select("path", "offset", "steps", "valid",
                         F.is_valid_utf8(joint.cast("string")).alias("joint"))
    files = edges.groupBy("path").agg(
        F.bool_and(F.col("valid") & F.col("joint")).alias("utf8"),
        F.sort_array(F.collect_list(F.struct("offset", "steps"))).alias("chunks"))
    states = files.select("path", F.col("chunks.offset").alias("offset"),
                          _run(F.col("chunks")).alias("state"))
    states = states.select("path", F.explode(F.arrays_zip("offset", "state")).alias("x")) \
        .select("path", "x.offset", "x.state")
    kind = F.lit(encoding) if encoding else F.when(F.col("utf8"), "UTF-8").otherwise(F.lit(fallback))
    reason = F.when(F.col("mark").isin("FFFE", "FEFF"), "UTF-16 cannot be read in ranges").when(
        (F.octet_length("header_line") + 3 >= F.col("n")) & (F.col("n") < F.col("size_bytes")),
        "header longer than a chunk")
    out = first.join(files.select("path", "utf8"), "path").withColumn("encoding", kind)
    # the header was cut out as UTF-8; in another charset it is read from its bytes again
    again = F.regexp_extract(decoded(F.col("start"), F.col("encoding"), encoding or fallback),
                             FIRST_RECORD, 1)
    follows = F.regexp_extract(F.substr(
        decoded(F.col("start"), F.col("encoding"), encoding or fallback),
        F.length(again) + 1), r"^(?:\r\n|\n|\r)", 0)
    return out.select("path", "size_bytes", "delimiter", again.alias("header_line"), "encoding",
                      F.lit(True).alias("multi_line"), reason.alias("reason"),
                      follows.alias("line_break")), states


def _hint(small: DataFrame) -> DataFrame:
    """One short row per file or chunk: broadcast where there are few."""
    return F.broadcast(small) if small.count() <= MAX_BROADCAST else small


def records(chunks: DataFrame, files: DataFrame, states: DataFrame,
            fallback: str = FALLBACK_ENCODING, as_plain: int = 0) -> DataFrame:
    """(path, block, record) of ``files``, without headers and blank lines, in file order.
    ``as_plain``: in files up to so many bytes the file's own line break becomes LF inside quotes
    too, as the plain reader has it."""
    known = materialize(states.join(files.select("path", "delimiter", "encoding"), "path"),
                        "csv-states")
    rows = chunks.join(_hint(known), ["path", "offset"]).select(
        "path", "offset", "delimiter", "state", "encoding", "content")
    pieces = materialize(rows.mapInArrow(_split(False), _RECORDS), "csv-pieces")
    number = F.sum(F.col("starts").cast("int")).over(
        W.partitionBy("path").orderBy("block", "starts").rowsBetween(W.unboundedPreceding, 0))
    joined = pieces.withColumn("number", number).where("number > 0").groupBy("path", "number").agg(
        F.sort_array(F.collect_list(F.struct("block", "starts", "record"))).alias("parts"),
        F.first("encoding").alias("encoding"))
    joined = joined.select("path", F.col("parts")[0]["block"].alias("block"), "encoding",
                           F.aggregate("parts", F.lit(b""), lambda acc, x: F.concat(
                               acc, x["record"])).alias("record"))
    out = rows.mapInArrow(_split(True), _RECORDS).drop("starts").unionByName(joined)
    text = F.regexp_replace(decoded(F.col("record"), F.col("encoding"), fallback),
                            r"(?:\r\n|\n|\r)\z", "")
    if as_plain:
        breaks = files.where((F.col("size_bytes") <= as_plain) & F.col("line_break").startswith("\r"))
        breaks = breaks.select("path", "line_break")
        if not breaks.isEmpty():
            out = out.join(_hint(breaks), "path", "left")
            text = F.when(F.col("line_break").isNull(), text).otherwise(
                F.replace(text, F.col("line_break"), F.lit("\n")))
    return out.select("path", "block", text.alias("record")).where(
        F.col("record").rlike(r"[^\x00-\x20]"))
