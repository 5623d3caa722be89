"""Large gzip files in many tasks: an index of places where inflating can start again.

A gzip file has no places to split at, so one file is one task.  Here a first
pass inflates each file once, as a stream, and notes a restart point about every
``spacing`` compressed bytes: the bit at which a deflate block begins, the
32 KiB of text before it that the block may refer to, and the lines so far.
The index is a small table (some 33 KiB a point) that is written once;
from then on each stretch between two points is a task of its own, which knows
the numbers of its lines.

Where a block begins isn't told by the library that inflates.  Bits that could
be the header of a block with its own codes are found with array arithmetic (its
code lengths have to make a complete code, which few bits do by chance), and
one of them is a point if inflating from there gives the very text that
the pass itself goes on with.  A stretch that begins within a byte is
inflated behind empty blocks of as many bits as are missing.

A file without such blocks (one short block, or blocks that aren't compressed)
has fewer points, or only its start; the rows are the same.  Members that
follow one another are one text.  A damaged file fails in the first pass, by
the library's checksum.  A line belongs to the stretch that it begins in.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..scratch import materialize
from ..ship import ship

POINTS = "path string, point int, byte long, bit int, text_at long, rows_before long, window binary"
SPACING, REGION, CHUNK, WINDOW, TRAILER = 32 << 20, 1 << 18, 1 << 18, 1 << 15, 8


def _bits(text: str) -> int:
    """A number from bits in the order in which they are read."""
    return int(text[::-1], 2)


# Empty blocks of 10 bits (fixed codes) and of 93 bits (own codes, of which only the end of the block is used).
_TEN = "0" + "10" + "0000000"
_OWN = "0" + "01" + "00000" + "00000" + "1111" + "".join("100" if s in (18, 1) else "000" for s in (16, 17, 18, 0, 8, 7, 9, 6, 10, 5, 11, 4, 12, 3, 13, 2, 14, 1, 15)) + "1" + "1111111" + "1" + "1101011" + "0" + "0" + "0"


def lead(bit: int) -> tuple[bytes, int]:
    """Whole bytes of empty blocks, and the low ``bit`` bits of the byte that follows."""
    blocks = _OWN if bit % 2 else ""
    while len(blocks) % 8 != bit:
        blocks += _TEN
    whole = len(blocks) // 8 * 8
    return _bits(blocks[:whole] or "0").to_bytes(whole // 8, "little"), _bits(blocks[whole:] or "0")


def inflater(bit: int, window: bytes, first: int):
    """An inflater that goes on within byte ``first``, and the bytes to give it for that byte."""
    before, low = lead(bit)
    return zlib.decompressobj(-15, zdict=window) if window else zlib.decompressobj(-15), before + bytes([first & (0xFF << bit) & 0xFF | low])


def possible_blocks(data: bytes) -> np.ndarray:
    """Bit positions of ``data`` that may begin a block with codes of its own, ascending."""
    bits = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little")
    n = len(bits) - 80
    if n <= 0:
        return np.zeros(0, np.int64)
    at = np.flatnonzero((bits[1 : n + 1] == 0) & (bits[2 : n + 2] == 1))
    value = lambda where, start, width: sum(bits[where + start + k].astype(np.int32) << k for k in range(width))
    at = at[value(at, 3, 5) <= 29]
    at = at[value(at, 8, 5) <= 29]
    lengths = value(at, 13, 4) + 4
    share = np.zeros(len(at), np.int32)
    for k in range(19):
        size = np.where(k < lengths, value(at, 17 + 3 * k, 3), 0)
        share += np.where(size > 0, 128 >> size, 0)
    return at[share == 128]


def rows_of(text: bytes) -> int:
    """Lines that hold more than white space, the last one too if it isn't ended."""
    return sum(map(bool, map(bytes.strip, text.split(b"\n"))))


class _Pass:
    """One file inflated in order; ``points`` gives its restart points."""

    def __init__(self, stream, spacing: int):
        self.stream, self.spacing = stream, spacing
        self.byte = self.text = self.rows = 0
        self.window, self.open_line = b"", b""

    def took(self, text: bytes) -> None:
        self.text += len(text)
        self.window = (self.window + text)[-WINDOW:]
        lines = self.open_line + text
        cut = lines.rfind(b"\n") + 1
        self.rows += rows_of(lines[:cut])
        self.open_line = lines[cut:]

    def points(self) -> Iterator[tuple[int, int, int, int, bytes]]:
        """(byte, bit, text_at, rows_before, window); rows before are those that begin before."""
        yield 0, -1, 0, 0, b""  # the start, header and all
        member, ahead, due, step = zlib.decompressobj(31), b"", self.spacing, min(CHUNK, self.spacing)
        while True:
            looking = self.byte >= due
            while len(ahead) < (REGION if looking else step) and (more := self.stream.read(step)):
                ahead += more
            if member.eof and not ahead.strip(b"\0"):  # padding at most
                yield -1, -1, self.text, self.rows + bool(self.open_line.strip()), b""  # the end
                return
            if not ahead:
                raise ValueError("the file ends within its data")
            if member.eof:
                member = zlib.decompressobj(31)
            if looking and (found := self.point_in(member, ahead)):
                due = found[0] + self.spacing
                yield found
            data, ahead = ahead[:step], ahead[step:]
            self.took(member.decompress(data))
            self.byte += len(data) - len(member.unused_data)
            ahead = member.unused_data + ahead

    def point_in(self, member, data: bytes) -> tuple[int, int, int, int, bytes] | None:
        ahead, fed, text, window, lines = member.copy(), 0, self.text, self.window, self.open_line
        rows = self.rows
        for at in possible_blocks(data[:REGION]).tolist():
            byte, bit = divmod(at, 8)
            # All that comes before a block is text by the time its first byte is in: its own header is far longer than a byte.
            more = ahead.decompress(data[fed : byte + 1])
            if ahead.eof:
                return None
            fed, text, window = byte + 1, text + len(more), (window + more)[-WINDOW:]
            lines += more
            cut = lines.rfind(b"\n") + 1
            rows, lines = rows + rows_of(lines[:cut]), lines[cut:]
            start, first = inflater(bit, window, data[byte])
            try:
                tried = start.decompress(first + data[byte + 1 :])
            except zlib.error:
                continue
            true = ahead.copy().decompress(data[byte + 1 :])
            if len(tried) >= 1024 and (tried.startswith(true) or true.startswith(tried)):
                return self.byte + byte, bit, text, rows + bool(lines.strip()), window
        return None


def _open(path: str):
    from pyarrow import fs

    store, inside = fs.FileSystem.from_uri(path)
    return store.open_input_file(inside)


def restart_points(spark: SparkSession, files: DataFrame, spacing: int = SPACING) -> DataFrame:
    """Rows of ``POINTS`` for the gzip files of ``files(path)``, one task a file; written to the shared folder."""
    ship(spark)

    def find(batches):
        for pdf in batches:
            for path in pdf["path"]:
                with _open(path) as stream:
                    for k, point in enumerate(_Pass(stream, spacing).points()):
                        yield pd.DataFrame([(path, k, *point)], columns=[c.split()[0] for c in POINTS.split(", ")])

    return materialize(files.select("path").repartition(max(1, files.count())).mapInPandas(find, POINTS), "restart_points")


def _stretch(path: str, byte: int, bit: int, window: bytes) -> Iterator[bytes]:
    """The text from a restart point on."""
    with _open(path) as stream:
        stream.seek(byte)
        data = stream.read(CHUNK)
        if bit < 0:
            member = zlib.decompressobj(31)
        else:
            member, first = inflater(bit, window, data[0])
            yield member.decompress(first)
            data = data[1:]
        raw = bit >= 0
        while data or (data := stream.read(CHUNK)):
            yield member.decompress(data)
            data = b""
            if member.eof:
                rest = member.unused_data
                while raw and len(rest) < TRAILER and (more := stream.read(CHUNK)):
                    rest += more
                rest = rest[TRAILER:] if raw else rest
                member, raw, data = zlib.decompressobj(31), False, rest or stream.read(CHUNK)
                if not data.strip(b"\0"):
                    return


def lines_of(chunks: Iterator[bytes], text_at: int, until: int | None, at_start: bool, row: int) -> Iterator[tuple[int, str]]:
    """(row number from 1, line) of the lines that begin in [text_at, until) and hold more than white space."""
    held, here = b"", text_at  # here: where held begins
    for chunk in chunks:
        held += chunk
        end = held.rfind(b"\n") + 1
        if not end:
            continue
        for line in held[:end].split(b"\n")[:-1]:
            if at_start:
                if until is not None and here >= until:
                    return
                if line.strip():
                    row += 1
                    yield row, line.rstrip(b"\r").decode("utf-8", "replace")
            at_start = True
            here += len(line) + 1
        held = held[end:]
    if held.strip() and at_start and (until is None or here < until):
        yield row + 1, held.rstrip(b"\r").decode("utf-8", "replace")


def gzip_lines(points: DataFrame, batch: int = 20_000) -> DataFrame:
    """(path, row_no, line) of the indexed files, a task for each stretch; the first line of a file is number 1."""
    from pyspark.sql import Window

    spark = points.sparkSession
    ship(spark)
    after = F.lead("text_at").over(Window.partitionBy("path").orderBy("point"))
    stretches = points.withColumn("until", F.coalesce(after, F.lit(-1).cast("long"))).filter("byte >= 0")

    def read(batches):
        for pdf in batches:
            for p in pdf.itertuples(index=False):
                at_start = p.bit < 0 or p.window[-1:] == b"\n"
                rows: list[tuple[int, str]] = []
                for found in lines_of(_stretch(p.path, p.byte, p.bit, p.window), p.text_at, p.until if p.until >= 0 else None, at_start, p.rows_before):
                    rows.append(found)
                    if len(rows) >= batch:
                        yield pd.DataFrame({"path": p.path, "row_no": [n for n, _ in rows], "line": [x for _, x in rows]})
                        rows = []
                if rows:
                    yield pd.DataFrame({"path": p.path, "row_no": [n for n, _ in rows], "line": [x for _, x in rows]})

    dealt = stretches.repartitionByRange(max(1, points.count()), "path", "point")
    return dealt.mapInPandas(read, "path string, row_no long, line string")


def read_gzip(spark: SparkSession, path: str, delimiter: str | None = None, spacing: int = SPACING, across: bool = False) -> DataFrame:
    """The gzip files of a path (all with the header of the first) as text columns and ``source_row_number``, read in as many tasks as there are stretches.

    A row's number is its place in its file, from 1; ``across`` counts on over the files in the order of their paths.
    """
    from pyspark.sql import Window

    from .delimited import head_of, sniff_delimiter

    head = head_of(spark, path)
    sep = delimiter or sniff_delimiter(head)
    header = spark.createDataFrame([(head.split("\n", 1)[0].rstrip("\r"),)], "line string")
    first = spark.read.csv(header.rdd.map(lambda r: r[0]), sep=sep, quote='"', escape='"').first()
    names = [x or f"_c{k}" for k, x in enumerate(first)]
    files = spark.read.format("binaryFile").load(path).select("path")
    schema = StructType([StructField(f"c{k}", StringType()) for k in range(len(names))])
    points = restart_points(spark, files, spacing)
    lines = gzip_lines(points).filter("row_no > 1")
    if across:  # a row per file is ranked
        earlier = Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
        held = points.filter("byte < 0").select("path", (F.col("rows_before") - 1).alias("rows"))
        lines = lines.join(held.select("path", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before")), "path").withColumn("row_no", F.col("row_no") + F.col("before"))
    cells = F.from_csv("line", F.lit(schema.simpleString()[7:-1].replace(":", " ")), {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE"})
    parsed = lines.select((F.col("row_no") - 1).alias("source_row_number"), cells.alias("c"))
    return parsed.select(*[F.col(f"c.c{k}").alias(n) for k, n in enumerate(names)], "source_row_number")
