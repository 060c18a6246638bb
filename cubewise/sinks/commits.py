"""Commit logs on shared storage: what a folder's readers may see.

A log is a folder ``_commits`` of numbered entries. An entry is written once,
under the next free number, by a create that fails if the file exists; so of two
writers one wins and the other learns of it, without a lock. An entry ends with
its own checksum; one whose writer died halfway does not count. Readers take
the last whole entry. Data files are written before the entry that names them,
under names never used before, and are not touched afterwards.

Only names and small counts pass through the driver here, never rows.
"""

from __future__ import annotations

import json
import zlib
from dataclasses import dataclass

from pyspark.sql import SparkSession

LOG = "_commits"


class ConcurrentCommit(RuntimeError):
    """Another writer has taken the number."""


class Folder:
    """A folder of the file system its path names (any that Hadoop knows)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.hadoop = spark._jvm.org.apache.hadoop
        self.fs = self.at().getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, *names: str):
        return self.hadoop.fs.Path("/".join([self.path, *names]))

    def exists(self, *names: str) -> bool:
        return self.fs.exists(self.at(*names))

    def names(self, *names: str, folders: bool | None = None) -> list[str]:
        """Names in the folder, sorted; all, only folders or only files."""
        if not self.exists(*names):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.at(*names))
                      if folders is None or s.isDirectory() == folders)

    def read(self, *names: str) -> bytes:
        stream = self.fs.open(self.at(*names))
        try:
            return bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def create(self, data: bytes, *names: str) -> bool:
        """Write a new file; False if there is one of that name."""
        self.fs.mkdirs(self.at(*names).getParent())
        try:
            stream = self.fs.create(self.at(*names), False)
        except Exception as e:
            if self.exists(*names):
                return False
            raise e
        try:
            stream.write(bytearray(data))
        finally:
            stream.close()
        return True

    def delete(self, *names: str) -> None:
        self.fs.delete(self.at(*names), True)

    def raw_path(self) -> str:
        """The folder's path as it stands in ``_metadata.file_path`` (percent-encoded)."""
        return self.fs.makeQualified(self.at()).toUri().getRawPath().rstrip("/")


@dataclass(frozen=True)
class Entry:
    number: int
    content: dict


class CommitLog:
    """The log of a folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.folder = Folder(spark, path)

    def numbers(self) -> list[int]:
        return [int(n[1:-5]) for n in self.folder.names(LOG) if n.startswith("_") and n.endswith(".json")]

    def entry(self, number: int) -> Entry | None:
        """An entry, or None if it is not whole."""
        body, _, check = self.folder.read(LOG, name_of(number)).rpartition(b"\n")
        if not check or check != checksum(body):
            return None
        return Entry(number, json.loads(body))

    def last(self) -> Entry | None:
        for number in reversed(self.numbers()):
            if (entry := self.entry(number)) is not None:
                return entry
        return None

    def entries(self) -> list[Entry]:
        return [e for n in self.numbers() if (e := self.entry(n)) is not None]

    def append(self, content: dict, after: int) -> Entry:
        """Commit under the first number behind ``after`` (0: an empty log), the
        number of the last entry that the writer has seen. Broken entries in
        between are passed over; a whole one raises ConcurrentCommit."""
        body = json.dumps(content, sort_keys=True).encode()
        number = after + 1
        while not self.folder.create(body + b"\n" + checksum(body), LOG, name_of(number)):
            if self.entry(number) is not None:
                raise ConcurrentCommit(f"{self.folder.path}: entry {number} is another writer's")
            number += 1
        return Entry(number, content)


def name_of(number: int) -> str:
    # The underscore hides entries from scans of the folder around them.
    return f"_{number:012d}.json"


def checksum(body: bytes) -> bytes:
    return f"{zlib.crc32(body):08x}".encode()
