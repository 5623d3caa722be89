"""``spark.read.format("yearly_source")``: yearly files on the web or in a store, probed and fetched by executors.

A source is a year: one partition, so years are probed and fetched side by
side and a lost executor costs its years only.  A row per year says where its
file is expected, whether a page links it, whether it is there, and, with
``folder``, where it lies now, its bytes and its SHA-256, taken as it streams by.

Options
    years    ``1992-1998`` or ``1992,1995``.
    address  where a year's file is expected, with ``{year}``; a folder is read
             as its files one after the other, by name.
    pages    saved web pages (files or folders, parted by ``;``) whose links
             count as the address of their year; ``base`` is their own address.
    pattern  what a link must fit; its first group is the year.
    folder   where to put the files, shared by all executors; none: only probe.

Restart.  An attempt writes ``year.part-ATTEMPT`` and moves it to ``year.gz``
(``year.data`` where the address ends otherwise) when it is whole.  A later attempt takes over the longest part that it finds by
moving it to a name of its own, counts it into its digest and asks for the rest
only; a server that sends the whole file again, or a store that can't append, starts anew.  Two
attempts never write one file, and the move makes the last of them count.  A
file that is there already is not fetched again: its digest is taken from it.

States are those of :func:`.remote.discover`, then ``downloaded`` and ``download_error``.
"""

from __future__ import annotations

import hashlib
import re
import sys
import urllib.error
import urllib.request
import uuid
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "year int, url string, status string, http_status int, content_length long, probe_method string, error string, path string, bytes long, sha256 string"
CHUNK = 1 << 20
AGENT = {"User-Agent": "quipu (+public data research)"}
# Fixed value: how yearly files are named where they are published.
LINK = r"/data/pagos-(\d{4})\.gz$"


def years_of(text: str) -> list[int]:
    out: set[int] = set()
    for part in text.split(","):
        low, _, high = part.strip().partition("-")
        out.update(range(int(low), int(high or low) + 1))
    return sorted(out)


def on_web(url: str) -> bool:
    return url.startswith(("http://", "https://"))


def store_of(uri: str):
    """A file system and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def files_of(uri: str) -> list:
    """What a store holds there: the file, or the files of a folder by name without hidden ones; empty if there is nothing."""
    from pyarrow import fs

    store, path = store_of(uri)
    found = store.get_file_info(path)
    if found.type == fs.FileType.File:
        return [found]
    if found.type == fs.FileType.NotFound:
        return []
    inside = store.get_file_info(fs.FileSelector(path, recursive=True))
    return sorted((f for f in inside if f.type == fs.FileType.File and not f.base_name.startswith((".", "_"))), key=lambda f: f.path)


def probed(url: str, timeout: float = 30) -> dict:
    """available, http_status, content_length, probe_method, error of an address."""
    if not on_web(url):
        try:
            files = files_of(url)
        except (OSError, ValueError) as e:
            return {"available": False, "error": type(e).__name__, "probe_method": "STORE"}
        return {"available": bool(files), "content_length": sum(f.size for f in files) if files else None, "probe_method": "STORE"}
    from .remote import probe

    found = probe(url, timeout)
    length = found.get("content_length")
    return found | {"content_length": int(length) if length else None}


def chunks(url: str, start: int, timeout: float = 120) -> tuple[int, Iterator[bytes]]:
    """What follows ``start``, and where that really is: 0 if the rest can't be had alone."""
    if on_web(url):
        asked = urllib.request.Request(url, headers=AGENT | ({"Range": f"bytes={start}-"} if start else {}))
        try:
            response = urllib.request.urlopen(asked, timeout=timeout)
        except urllib.error.HTTPError as e:
            if e.code != 416 or not start:
                raise
            return start, iter(())  # nothing follows: the part is whole
        at = start if start and response.status == 206 else 0
        return at, iter(lambda: response.read(CHUNK), b"")

    def read() -> Iterator[bytes]:
        store, _ = store_of(url)
        left = start
        for f in files_of(url):
            if left >= f.size:
                left -= f.size
                continue
            with store.open_input_file(f.path) as stream:
                stream.seek(left)
                left = 0
                while block := stream.read(CHUNK):
                    yield block

    return start, read()


def _digest(store, path: str, whole=None) -> tuple[object, int]:
    whole, size = whole or hashlib.sha256(), 0
    with store.open_input_stream(path, compression=None) as stream:
        while block := stream.read(CHUNK):
            whole.update(block)
            size += len(block)
    return whole, size


def fetch(url: str, folder: str, name: str) -> dict:
    """path, bytes and sha256 of the file, fetched or found below ``folder``."""
    from pyarrow import fs

    store, base = store_of(folder)
    store.create_dir(base, recursive=True)
    kind = "gz" if url.endswith(".gz") else "data"
    target, mine = f"{base}/{name}.{kind}", f"{base}/{name}.part-{uuid.uuid4().hex}"
    path = f"{folder.rstrip('/')}/{name}.{kind}"
    if store.get_file_info(target).type == fs.FileType.File:
        whole, size = _digest(store, target)
        return {"path": path, "bytes": size, "sha256": whole.hexdigest()}
    parts = [f for f in store.get_file_info(fs.FileSelector(base)) if f.base_name.startswith(f"{name}.part-")]
    whole, size = hashlib.sha256(), 0
    for part in sorted(parts, key=lambda f: -f.size)[:1]:
        try:
            store.move(part.path, mine)
        except OSError:
            break  # another attempt has it
        whole, size = _digest(store, mine)
    at, rest = chunks(url, size)
    out = None
    if size and at == size:
        try:
            out = store.open_append_stream(mine)
        except (OSError, NotImplementedError):
            at, rest = chunks(url, 0)
    if out is None:
        if at:
            at, rest = chunks(url, 0)
        whole, size, out = hashlib.sha256(), 0, store.open_output_stream(mine)
    with out:
        for block in rest:
            out.write(block)
            whole.update(block)
            size += len(block)
    store.move(mine, target)
    return {"path": path, "bytes": size, "sha256": whole.hexdigest()}


class Year(InputPartition):
    def __init__(self, year: int, url: str, linked: bool):
        self.year, self.url, self.linked = year, url, linked


class YearlyReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[Year]:
        from .remote import linked_years

        o = self.options
        linked: dict[int, str] = {}
        for uri in filter(None, (o.get("pages") or "").split(";")):
            store, _ = store_of(uri)
            for f in files_of(uri):
                with store.open_input_stream(f.path) as stream:
                    linked |= linked_years(stream.read().decode("utf-8", "replace"), o.get("base") or uri, o.get("pattern") or LINK)
        return [Year(y, linked.get(y) or re.sub(r"\{year\}", str(y), o["address"]), y in linked) for y in sorted({*linked, *years_of(o["years"])})]

    def read(self, part: Year) -> Iterator[tuple]:
        found, held = probed(part.url), {}
        if found["available"]:
            status = "linked_available" if part.linked else "probed_available"
        else:
            status = "linked_unavailable" if part.linked else "probe_error" if "error" in found else "probed_missing"
        error = found.get("error")
        if found["available"] and self.options.get("folder"):
            try:
                held, status = fetch(part.url, self.options["folder"], str(part.year)), "downloaded"
            except (OSError, ValueError) as e:
                status, error = "download_error", type(e).__name__
        yield (
            part.year, part.url, status, found.get("http_status"), found.get("content_length"), found.get("probe_method"), error,
            held.get("path"), held.get("bytes"), held.get("sha256"),
        )


class YearlySource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "yearly_source"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> YearlyReader:
        return YearlyReader(dict(self.options))


def register(spark: SparkSession) -> None:
    """Make ``yearly_source`` a format of this session; its code travels with the plan, since planners and workers needn't have this package."""
    from . import remote

    for module in (sys.modules[__name__], remote):
        cloudpickle.register_pickle_by_value(module)
    spark.dataSource.register(YearlySource)
