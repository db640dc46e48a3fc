"""Reading parts of files inside tasks: first lines of delimited files, directories and single members of zip archives.

Tasks open files through Arrow's file systems, which read by position; only paths and small results pass the driver."""

from __future__ import annotations

import csv as delimited
import struct
import zipfile
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MEMBERS = "archive string, member string, size long, text string"
ENTRIES = "path string, archive string, member string, size long, packed long, at long, method int"
#: Bytes of text after which a task passes members on, and the first read of a header.
BATCH, FIRST = 8 << 20, 1 << 14


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, and the path in it."""
    if "://" not in path:
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def _dealt(spark: SparkSession, paths: list[str]) -> DataFrame:
    tasks = max(1, min(len(paths), 4 * spark.sparkContext.defaultParallelism))
    return spark.createDataFrame([(p,) for p in paths], "path string").repartition(tasks)


def first_line(path: str) -> str:
    """The first line of a file, or of the first file in a folder; '' where there is none."""
    store, at = located(path)
    if store.get_file_info(at).type == fs.FileType.Directory:
        files = [f for f in store.get_file_info(fs.FileSelector(at)) if f.is_file and not f.base_name.startswith(("_", "."))]
        if not files:
            return ""
        at = min(f.path for f in files)
    with store.open_input_stream(at) as stream:
        held = b""
        while b"\n" not in held:
            more = stream.read(FIRST)
            if not more:
                break
            held += more
    return held.split(b"\n", 1)[0].rstrip(b"\r").decode("utf-8", "replace").lstrip("﻿")


def known(path: str) -> bool:
    """Whether Arrow has a file system for the path."""
    try:
        located(path)
        return True
    except (pa.ArrowInvalid, OSError):
        return False


def _first_line_by_hadoop(spark: SparkSession, path: str) -> str:
    """first_line() on the driver, for stores that only Spark's own readers open."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    store = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if store.getFileStatus(at).isDirectory():
        own = [s.getPath() for s in store.listStatus(at) if s.isFile() and not s.getPath().getName().startswith(("_", "."))]
        if not own:
            return ""
        at = min(own, key=str)
    stream = store.open(at)
    try:
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()
    return (line or "").lstrip("\ufeff")


def _names(line: str) -> list[str]:
    return [x.strip() for x in next(delimited.reader([line]), [])]


def headers(spark: SparkSession, paths: list[str]) -> dict[str, tuple[str, ...]]:
    """The column names of delimited files by path; nothing but first lines is read, by tasks. Where Arrow has no file
    system for their store, the driver reads them one after another."""

    def run(batches):
        for batch in batches:
            names = [_names(first_line(p)) for p in batch.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("path"), pa.array(names, pa.list_(pa.string()))], ["path", "names"]
            )

    if not paths:
        return {}
    if not known(paths[0]):
        return {p: tuple(_names(_first_line_by_hadoop(spark, p))) for p in paths}
    found = _dealt(spark, paths).mapInArrow(run, "path string, names array<string>").collect()
    return {r.path: tuple(r.names) for r in found}


def archive_entries(spark: SparkSession, paths: list[str], suffix: str = ".gml") -> DataFrame:
    """(path, archive, member, size, packed, at, method) of the members of zip archives, from their directories: the ends
    of the archives are read, and nothing is inflated."""

    def run(batches):
        schema = pa.schema(
            [(c, pa.string()) for c in ("path", "archive", "member")]
            + [(c, pa.int64()) for c in ("size", "packed", "at")]
            + [("method", pa.int32())]
        )
        for batch in batches:
            for path in batch.column("path").to_pylist():
                name = path.rsplit("/", 1)[-1].rsplit(".", 1)[0]
                store, at = located(path)
                with store.open_input_file(at) as file, zipfile.ZipFile(file) as z:
                    own = [m for m in z.infolist() if m.filename.lower().endswith(suffix)]
                    rows = [
                        (path, name, f"{name}_{m.filename.rsplit('/', 1)[-1]}", m.file_size, m.compress_size, m.header_offset, m.compress_type)
                        for m in own
                    ]
                for k in range(0, len(rows), 10_000):
                    columns = zip(*rows[k : k + 10_000], strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
                    )

    if not paths:
        return spark.createDataFrame([], ENTRIES)
    return _dealt(spark, paths).mapInArrow(run, ENTRIES)


def read_member(file, at: int, packed: int, method: int) -> bytes:
    """The contents of the member whose own header begins at a place of an open archive."""
    file.seek(at)
    head = file.read(30)
    if head[:4] != b"PK\x03\x04" or method not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED) or head[6] & 1:
        raise ValueError(f"the member at {at} is not stored or deflated in the clear")
    name, extra = struct.unpack("<HH", head[26:30])
    file.seek(at + 30 + name + extra)
    data = file.read(packed)
    return zlib.decompress(data, -15) if method == zipfile.ZIP_DEFLATED else data


def member_batch(rows: list[tuple]) -> pa.RecordBatch:
    """Rows of MEMBERS."""
    kinds = (pa.string(), pa.string(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["archive", "member", "size", "text"]
    )


def member_texts(entries: DataFrame) -> DataFrame:
    """(archive, member, size, text) of archive_entries(): a task reads a stretch of an archive's members, one at a
    time, so archives may be larger than its memory."""

    def run(batches):
        open_, held, size = (None, None), [], 0

        try:
            for batch in batches:
                for r in batch.to_pylist():
                    if open_[0] != r["path"]:
                        if open_[1]:
                            open_[1].close()
                        store, at = located(r["path"])
                        open_ = r["path"], store.open_input_file(at)
                    text = read_member(open_[1], r["at"], r["packed"], r["method"]).decode("utf-8", "replace")
                    held.append((r["archive"], r["member"], r["size"], text))
                    size += len(text)
                    if size > BATCH:
                        yield member_batch(held)
                        held, size = [], 0
            if held:
                yield member_batch(held)
        finally:
            if open_[1]:
                open_[1].close()

    dealt = entries.repartitionByRange("path", "at").sortWithinPartitions("path", "at")
    return dealt.mapInArrow(run, MEMBERS)
