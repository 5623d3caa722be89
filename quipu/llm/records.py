"""Token-id files: length-delimited binary records with masked checksums.

A data file ``part-NNNNN-ATTEMPT.rec`` holds one frame per record:

    u64 length | u32 masked crc of these 8 bytes | payload | u32 masked crc of the payload

all little-endian, as in the widely used record files, with CRC-32 as the
checksum.  The payload is: i64 key | u8 key present | u8 bytes per id | ids.
Beside it ``part-NNNNN-ATTEMPT.idx`` holds for each record its u64 offset and u64
count of ids, so that a reader can fetch records in any order.

Texts are encoded where they are read; what is shuffled into key order is ids of
two bytes.  The number of files follows the bytes of the texts, and where each
begins is found on keys and hashes alone.  Executors write
each file under a name of its attempt, which is never moved or written over:
the task that ends well tells the driver its name, so that a task that runs
twice clashes with nothing, and what other attempts left is deleted.

Defined results
    null or empty text: the end id alone.  Rows without a key come first.
    Repeated rows are separate records, ordered by a hash of their text.  A very long text
    is one record.  Extra columns, whatever their names, are ignored; an empty
    table gives no records.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import key_columns, keys_of, prepare, whole_numbers
from .bpe_cache import encoder

#: Bytes of text whose ids go to one file, about.
FILE_BYTES = 128 << 20

SCHEMA = "doc_id long, start long, n_tokens long, ids binary"
_HEAD, _CRC, _KEY, _INDEX = struct.Struct("<Q"), struct.Struct("<I"), struct.Struct("<qBB"), struct.Struct("<QQ")


def masked(data: bytes) -> int:
    """CRC-32, rotated by 15 bits and shifted by a constant, so that a checksum over data that holds checksums stays sound."""
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = _HEAD.pack(len(payload))
    return b"".join((head, _CRC.pack(masked(head)), payload, _CRC.pack(masked(payload))))


def payload_of(key: int | None, ids: bytes, width: int) -> bytes:
    return _KEY.pack(key or 0, key is not None, width) + ids


def parse(payload: bytes) -> tuple[int | None, np.ndarray]:
    key, present, width = _KEY.unpack_from(payload)
    return key if present else None, np.frombuffer(payload, f"<u{width}", offset=_KEY.size)


def index_entry(offset: int, ids: int) -> bytes:
    return _INDEX.pack(offset, ids)


def read_frame(stream) -> bytes | None:
    """The next payload, None at the end; ValueError if it is damaged."""
    head = stream.read(_HEAD.size + _CRC.size)
    if not head:
        return None
    if len(head) < _HEAD.size + _CRC.size or _CRC.unpack_from(head, _HEAD.size)[0] != masked(head[: _HEAD.size]):
        raise ValueError("damaged length")
    size = _HEAD.unpack_from(head)[0]
    body = stream.read(size + _CRC.size)
    if len(body) < size + _CRC.size or _CRC.unpack_from(body, size)[0] != masked(body[:size]):
        raise ValueError("damaged record")
    return body[:size]


def filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class File(NamedTuple):
    """A written file: its place in the order, its name without the ending, and what it holds."""

    number: int
    name: str
    records: int
    ids: int


def write_records(docs: DataFrame, folder: str, path: str, end_id: int = 2, text: str = "text", key: str = "doc_id", file_bytes: int = FILE_BYTES) -> list[File]:
    """Encode ``docs`` and write them in ascending key order, in files of about ``file_bytes`` (smaller ones where there would be fewer than cores)."""
    spark = docs.sparkSession
    prepare(spark)

    def write(batches):
        number, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        width = encoder(path).dtype.itemsize
        store, base = filesystem(folder)
        store.create_dir(base, recursive=True)
        name = f"part-{number:05d}-{attempt}"
        at = records = total = 0
        with store.open_output_stream(f"{base}/{name}.rec") as data, store.open_output_stream(f"{base}/{name}.idx") as index:
            for pdf in batches:
                for k, ids in zip(keys_of(pdf), pdf["ids"]):
                    framed = frame(payload_of(k, ids, width))
                    data.write(framed)
                    index.write(index_entry(at, len(ids) // width))
                    at, records, total = at + len(framed), records + 1, total + len(ids) // width
        yield pd.DataFrame({"number": [number], "name": [name], "records": [records], "ids": [total]})

    rows = docs.select(*key_columns(key), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t")).withColumn("h", F.xxhash64("t"))
    size = rows.agg(F.sum(F.octet_length("t").cast("long"))).first()[0] or 0
    n = max(1, -(-size // file_bytes), min(spark.sparkContext.defaultParallelism, size >> 20))
    # Where each file begins is found on keys and hashes alone: one row per file comes back.
    narrow = rows.select("keyed", "k", "h").repartitionByRange(n, "keyed", "k", "h").groupBy(F.spark_partition_id()).agg(F.min(F.struct("keyed", "k", "h")).alias("least"))
    starts = spark.sparkContext.broadcast(sorted((r["least"]["keyed"], r["least"]["k"], r["least"]["h"]) for r in narrow.collect())[1:])

    def encoded(batches):
        enc = encoder(path)
        end = np.array([end_id], enc.dtype).tobytes()
        for pdf in batches:
            pdf["number"] = [bisect_right(starts.value, place) for place in zip(pdf["keyed"].tolist(), pdf["k"].tolist(), pdf["h"].tolist())]
            pdf["ids"] = [enc.raw(t) + end for t in pdf.pop("t")]
            yield pdf[["number", "keyed", "k", "h", "ids"]]

    placed = rows.mapInPandas(encoded, "number int, keyed boolean, k long, h long, ids binary").repartitionById(len(starts.value) + 1, "number")
    ordered = placed.sortWithinPartitions("keyed", "k", "h", "ids").select("keyed", "k", "ids")
    # One row per file: the driver holds no more than the names.
    files = sorted(File(**r.asDict()) for r in ordered.mapInPandas(write, "number long, name string, records long, ids long").collect())
    sweep(folder, files)
    return files


def sweep(folder: str, files: list[File]) -> None:
    """Delete what attempts that did not count have left."""
    from pyarrow import fs

    store, base = filesystem(folder)
    known = {f.name for f in files}
    for found in store.get_file_info(fs.FileSelector(base, allow_not_found=True)):
        if found.base_name.startswith("part-") and found.base_name.rsplit(".", 1)[0] not in known:
            store.delete_file(found.path)


def iter_file(folder: str, name: str) -> Iterator[tuple[int | None, np.ndarray]]:
    """Keys and ids of one file, in its order; every checksum is verified."""
    store, base = filesystem(folder)
    with store.open_input_stream(f"{base}/{name}.rec", buffer_size=1 << 20) as stream:
        while (payload := read_frame(stream)) is not None:
            yield parse(payload)


def read_at(folder: str, name: str, wanted: list[int]) -> list[tuple[int | None, np.ndarray]]:
    """Records ``wanted`` of one file through its offset index, in the wanted order."""
    store, base = filesystem(folder)
    with store.open_input_stream(f"{base}/{name}.idx") as stream:
        offsets = [at for at, _ in _INDEX.iter_unpack(stream.read())]
    out = []
    with store.open_input_file(f"{base}/{name}.rec") as stream:
        for k in wanted:
            stream.seek(offsets[k])
            out.append(parse(read_frame(stream)))
    return out


def read_records(spark: SparkSession, folder: str, files: list[File], chunk: int = 500) -> DataFrame:
    """Rows of ``SCHEMA`` from the files: one task per file; ``start`` counts the ids of all records before."""
    held, total = [], 0
    for f in files:
        if f.records:
            held.append((f.name, total))
        total += f.ids

    def frame_of(rows):
        columns = dict(zip(("doc_id", "start", "n_tokens", "ids"), zip(*rows)))
        return pd.DataFrame(columns | {"doc_id": whole_numbers(columns["doc_id"])})

    def read(batches):
        for pdf in batches:
            for slot in pdf["id"]:
                name, start = held[slot]
                rows = []
                for key, ids in iter_file(folder, name):
                    rows.append((key, start, len(ids), ids.astype("<u4").tobytes()))
                    start += len(ids)
                    if len(rows) >= chunk:
                        yield frame_of(rows)
                        rows = []
                if rows:
                    yield frame_of(rows)

    return spark.range(0, len(held), 1, max(1, len(held))).mapInPandas(read, SCHEMA)
