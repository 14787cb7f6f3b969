"""Quoted CSV read by byte ranges: files with line breaks in quotes that many tasks share.

Spark's own reader takes such a file in one task, as only a reader from the start knows which line break ends a record. Here a first
pass runs over the lines of all byte ranges at once and notes, for each range, in which state it ends if it begins
outside and if it begins inside of quotes. These states, one row a range, are chained on the driver. The second pass reads the ranges
again, each from its true state, and gives whole records; a record that goes on over range ends comes as pieces of one
owner and is put together by a group of its pieces only. Cells are then read by Spark's CSV parser, record by record.

A quote opens a value only at a cell's start, as in Spark's reader; doubled quotes are one. Empty lines are left out. Where a file's first
line ends with carriage return and line feed, these two are one line feed in its cells, which is what that reader makes of them. The first record
of each file is its header; files with other headers are refused. Empty files have no rows.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..shipping import ship

#: Place of a record that its range does not end: behind all others of the range.
LAST = 1 << 40
_MARK = b"\xef\xbb\xbf"


def ends_inside(line: bytes, inside: bool, sep: bytes) -> bool:
    """If the quotes are open behind a line that begins with them open or closed."""
    at = 0
    while True:
        if inside:
            at = line.find(b'"', at)
            if at < 0:
                return True
            if line[at + 1 : at + 2] == b'"':
                at += 2
                continue
            inside = False
        elif line[at : at + 1] == b'"':
            inside, at = True, at + 1
            continue
        at = line.find(sep, at)
        if at < 0:
            return False
        at += len(sep)


def _runs(batches) -> Iterator[tuple[tuple[str, int], list[bytes], list[bool]]]:
    """Lines of one range of a file, as far as a batch holds them, and which of them have quotes."""
    for batch in batches:
        files, starts, lines = (batch.column(i) for i in range(3))
        quoted = pc.match_substring(lines, '"').to_pylist()
        keys, texts = list(zip(files.to_pylist(), starts.to_pylist())), lines.to_pylist()
        begin = 0
        for i in range(1, len(keys) + 1):
            if i == len(keys) or keys[i] != keys[begin]:
                yield keys[begin], texts[begin:i], quoted[begin:i]
                begin = i


_STATES = "file string, start long, outside boolean, inside boolean, outside_ends boolean, inside_ends boolean, header binary"
_NAMES = [c.split()[0] for c in _STATES.split(", ")]


def _range_states(sep: bytes):
    def run(batches):
        found: dict[tuple[str, int], dict] = {}
        for key, lines, quoted in _runs(batches):
            r = found.setdefault(key, {"now": [False, True], "ends": [False, False], "head": [] if key[1] == 0 else None, "header": None})
            for line, q in zip(lines, quoted):
                if q:
                    r["now"] = [ends_inside(line, s, sep) for s in r["now"]]
                r["ends"] = [e or not s for e, s in zip(r["ends"], r["now"])]
                if r["head"] is not None and (r["head"] or line.rstrip(b"\r")):
                    r["head"].append(line)
                    if not r["now"][0]:
                        r["header"], r["head"] = b"\n".join(r["head"]), None
        rows = [(f, s, *r["now"], *r["ends"], r["header"]) for (f, s), r in found.items()]
        types = (pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.bool_(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 7, types)], names=_NAMES)

    return run


_RECORDS = pa.schema([("file", pa.string()), ("owner", pa.int64()), ("start", pa.int64()), ("place", pa.int64()), ("whole", pa.bool_()), ("returns", pa.bool_()), ("value", pa.binary())])
_SHAPE = "file string, owner long, start long, place long, whole boolean, returns boolean, value binary"


def _records(sep: bytes, shared):
    def run(batches):
        chain, with_returns = shared.value
        now: tuple[str, int] | None = None
        held: list[bytes] = []
        inside = first = piece = returns = False
        place = owner = 0

        def flush(rows: list[tuple]) -> None:
            """What is left of a range is a piece; the rest of its record is in later ranges."""
            if held:
                rows.append((now[0], owner, now[1], LAST if place or not first else 0, False, now[0] in with_returns, b"\n".join(held)))
                held.clear()

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [()] * 7, _RECORDS)], schema=_RECORDS)

        for key, lines, quoted in _runs(batches):
            rows: list[tuple] = []
            if key != now:
                flush(rows)
                now, place = key, 0
                inside, owner = chain[key]
                returns = key[0] in with_returns
                first, piece = key[1] == 0, inside
            for line, q in zip(lines, quoted):
                if q:
                    inside = ends_inside(line, inside, sep)
                if not held and not inside and not piece:
                    if line and line != b"\r":
                        rows.append((key[0], key[1], key[1], place, True, returns, line))
                        place += 1
                    continue
                held.append(line)
                if not inside:
                    if piece:
                        flush(rows)
                        piece, owner = False, key[1]
                    else:
                        rows.append((key[0], key[1], key[1], place, True, returns, b"\n".join(held)))
                        place += 1
                        held.clear()
            yield batch_of(rows)
        rows = []
        if now:
            flush(rows)
        yield batch_of(rows)

    return run


def _chain(states: list) -> dict[tuple[str, int], tuple[bool, int]]:
    """For each range if it begins inside of quotes, and the range that its first record began in."""
    out: dict[tuple[str, int], tuple[bool, int]] = {}
    file, inside, owner = None, False, 0
    for r in sorted(states, key=lambda r: (r.file, r.start)):
        if r.file != file:
            file, inside, owner = r.file, False, r.start
        out[r.file, r.start] = (inside, owner if inside else r.start)
        ended = r.inside_ends if inside else r.outside_ends
        if ended or not inside:
            owner = r.start
        inside = r.inside if inside else r.outside
    return out


def _column_names(header: str, sep: str) -> list[str]:
    """Names as Spark's reader makes them: _c<i> for empty ones, a number behind repeated ones."""
    cells = next(csv.reader([header], delimiter=sep), [])
    lower = [c.lower() for c in cells]
    return [f"_c{i}" if not c else f"{c}{i}" if lower.count(c.lower()) > 1 else c for i, c in enumerate(cells)]


def read_csv_split(spark: SparkSession, path: str, *, sep: str = ",", encoding: str = "UTF-8", schema: StructType | None = None, order: str | None = None) -> DataFrame:
    """Every cell as text, with the header's names or those of `schema`. `order` names a column of structs that sorts rows as they stand in the files."""
    ship(spark)
    delimiter = sep.encode()
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("value"))
    states = lines.mapInArrow(_range_states(delimiter), _STATES).collect()  # a row per byte range
    headers = {r.file: r.header for r in states if r.header is not None}
    unread = {r.file for r in states} - set(headers)
    with_returns = {r.file for r in states if r.start == 0 and (r.header is None or b"\r\n" in r.header[: r.header.find(b"\n") + 1] or b"\n" not in r.header and r.header.endswith(b"\r"))}
    shared = spark.sparkContext.broadcast((_chain(states), with_returns))
    found = lines.mapInArrow(_records(delimiter, shared), _SHAPE)
    pieces = found.filter("NOT whole").groupBy("file", "owner", F.lit(None).cast("long").alias("start")).agg(F.sort_array(F.collect_list(F.struct("start", "place", "value"))).alias("p"), F.bool_or("returns").alias("returns"))
    joined = pieces.select("file", "owner", "start", F.when((F.col("p")[0]["start"] == 0) & (F.col("p")[0]["place"] == 0), 0).otherwise(LAST).cast("long").alias("place"), F.lit(True).alias("whole"), "returns", _newline_joined(F.col("p")).alias("value"))
    records = found.filter("whole").unionAll(joined)
    if unread:  # a header that its first range does not end
        headers |= {r.file: bytes(r.value) for r in records.filter(F.col("file").isin(*unread) & (F.col("owner") == 0) & (F.col("place") == 0)).collect()}
    names = {tuple(_column_names(h.removeprefix(_MARK).removesuffix(b"\r").decode(encoding), sep)) for h in headers.values()}
    if len(names) > 1:
        raise ValueError(f"{path} has files with different headers")
    if schema is None:
        if not names:
            return spark.createDataFrame([], StructType([]))
        schema = StructType([StructField(c, StringType()) for c in names.pop()])
    body = records.filter((F.col("owner") != 0) | (F.col("place") != 0))
    text = F.regexp_replace(F.decode("value", encoding), "\r$", "")
    cell = F.when(F.col("returns"), F.replace(text, F.lit("\r\n"), F.lit("\n"))).otherwise(text)
    options = {"sep": sep, "quote": '"', "escape": '"', "nullValue": "\0", "mode": "PERMISSIVE"}
    rows = body.select(F.struct("file", "owner", "place").alias("_at"), F.from_csv(cell, schema.toDDL(), options).alias("_row"))
    return rows.select(*([F.col("_at").alias(order)] if order else []), *[F.col("_row")[c].alias(c) for c in schema.names])


def _newline_joined(pieces):
    """Pieces of a record as one value, with the line breaks that stood between them."""
    parts = F.transform(pieces, lambda p: F.hex(p["value"]))
    return F.unhex(F.array_join(parts, "0A"))
