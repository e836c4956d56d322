"""ZIP archives of CSV members."""

from __future__ import annotations

import io
import posixpath
import zipfile
import zlib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from wicketworks.session import materialize

UNPACKED = "archive STRING, file_name STRING, text STRING"
_LISTED = "archive STRING, member STRING, reason STRING"
_READ = "archive STRING, file_name STRING, text STRING, reason STRING"
# A frame of members is handed on when it has so many rows or so many characters.
FRAME_ROWS = 1_000
FRAME_CHARS = 4_000_000
_BROKEN = (zipfile.BadZipFile, zlib.error, UnicodeDecodeError, NotImplementedError, EOFError, OSError, RuntimeError)


def _csv_names(archive: zipfile.ZipFile) -> list[str]:
    return [name for name in archive.namelist() if name.endswith(".csv")]


def _reason(error: Exception) -> str:
    return f"{type(error).__name__}: {error}"


def _frames(rows: Iterator[tuple], columns: Sequence[str]) -> Iterator[pd.DataFrame]:
    """Rows whose third value is a text, in frames of bounded size: a frame for each row would cost more than reading it."""
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += len(row[2] or "")
        if len(held) >= FRAME_ROWS or chars >= FRAME_CHARS:
            yield pd.DataFrame(held, columns=columns, dtype=object)
            held, chars = [], 0
    if held:
        yield pd.DataFrame(held, columns=columns, dtype=object)


class _File(io.RawIOBase):
    """A seekable file of any store that Arrow knows, so that a task reads only what it needs of an archive."""

    def __init__(self, path: str) -> None:
        from pyarrow import fs

        system, name = fs.FileSystem.from_uri(path)
        self.source = system.open_input_file(name)

    def seekable(self) -> bool:
        return True

    def readable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.source.tell()

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        try:
            return self.source.seek(offset, whence)
        except ValueError as error:  # as files do; the ZIP reader relies on it
            raise OSError(str(error)) from error

    def readinto(self, buffer) -> int:
        data = self.source.read(len(buffer))
        buffer[: len(data)] = data
        return len(data)

    def close(self) -> None:
        self.source.close()
        super().close()


def list_members(spark: SparkSession, path: str) -> DataFrame:
    """(archive, member, reason) of the CSV members of all archives in a directory.

    Only the central directory at the end of each archive is read. An archive without a readable one is
    a row with a reason and no member.
    """
    paths = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select("path")

    def names(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive in batch["path"]:
                try:
                    with _File(archive) as source, zipfile.ZipFile(source) as opened:
                        found = pd.DataFrame({"member": _csv_names(opened)}, dtype=object).assign(archive=archive, reason=None)
                except _BROKEN as error:
                    found = pd.DataFrame({"archive": [archive], "member": [None], "reason": [_reason(error)]})
                yield found[["archive", "member", "reason"]]

    return paths.mapInPandas(names, _LISTED)


def read_archives(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Members (archive, file_name, text) of all archives in a directory, and rejects (archive, file_name, reason).

    Archives are listed first and their members dealt over tasks, each of which seeks to the members that it
    got: one large archive is read by many tasks, and is never held in memory.
    """
    listed = materialize(list_members(spark, path), "members")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _frames(members_of(batches), ["archive", "file_name", "text", "reason"])

    def members_of(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        for batch in batches:
            for archive, members in batch.groupby("archive")["member"]:
                with _File(archive) as source, zipfile.ZipFile(source) as opened:
                    for member in members:
                        text, reason = None, None
                        try:
                            text = opened.read(member).decode("utf-8")
                        except _BROKEN as error:
                            reason = _reason(error)
                        yield archive, posixpath.basename(member), text, reason

    members = listed.where("member IS NOT NULL").select("archive", "member").repartition("archive", "member")
    unpacked = materialize(members.mapInPandas(read, _READ), "unpacked")
    rejected = unpacked.where("reason IS NOT NULL").select("archive", "file_name", "reason")
    unlisted = listed.where("reason IS NOT NULL").selectExpr("archive", "CAST(NULL AS STRING) AS file_name", "reason")
    return unpacked.where("reason IS NULL").drop("reason"), unlisted.unionByName(rejected)


def _members(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                for name in _csv_names(archive):
                    yield path, posixpath.basename(name), archive.read(name).decode("utf-8")


def unpack_archives(archives: DataFrame) -> DataFrame:
    """The CSV members of archives (path, content) that are rows already, without their directories."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _frames(_members(batches), ["archive", "file_name", "text"])

    return archives.select("path", "content").mapInPandas(unpack, UNPACKED)
