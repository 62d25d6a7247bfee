"""Folders of tables as wholes: swapped in when complete, and small files beside them.

Names that begin with an underscore are no part of a table for Spark, so what is being written, or was
replaced, is never read as data. Renaming a folder is one step on HDFS and on local disks; object
stores copy it file by file, so there a reader may see a part meanwhile.
"""

from __future__ import annotations

import posixpath
from uuid import uuid4

from pyspark.sql import SparkSession


class Files:
    """The file system of a path, by the session's Hadoop settings."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _place(self, path: str):
        place = self._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        place, files = self._place(path)
        return files.exists(place)

    def names(self, path: str) -> list[str]:
        """What a folder holds; nothing if it is not there."""
        place, files = self._place(path)
        return sorted(f.getPath().getName() for f in files.listStatus(place)) if files.exists(place) else []

    def listing(self, path: str) -> list[tuple[str, int, int]] | None:
        """Name, bytes and time of change of every file at or below a path; None without it."""
        place, files = self._place(path)
        if not files.exists(place):
            return None
        found, each = [], files.listFiles(place, True)
        while each.hasNext():
            file = each.next()
            found.append((file.getPath().getName(), file.getLen(), file.getModificationTime()))
        return sorted(found)

    def delete(self, path: str) -> None:
        place, files = self._place(path)
        files.delete(place, True)

    def rename(self, old: str, new: str) -> None:
        (source, files), (target, _) = self._place(old), self._place(new)
        files.mkdirs(target.getParent())
        if not files.rename(source, target):
            raise OSError(f"cannot rename {old} to {new}")

    def write_text(self, path: str, text: str) -> None:
        """A small file, complete or not at all."""
        part = beside(path, f"part-{uuid4().hex}")
        place, files = self._place(part)
        out = files.create(place, True)
        try:
            out.write(bytearray(text, "utf-8"))
        finally:
            out.close()
        self.delete(path)
        self.rename(part, path)

    def read_text(self, path: str) -> str:
        place, files = self._place(path)
        file = files.open(place)
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(file)).decode()
        finally:
            file.close()


def beside(path: str, kind: str) -> str:
    """A path in the same folder which is no table's."""
    folder, name = posixpath.split(path.rstrip("/"))
    return f"{folder}/_{name}.{kind}"


def swap_in(spark: SparkSession, new: str, path: str) -> None:
    """Put a complete folder in the place of ``path``; what was there goes when it is."""
    files, old = Files(spark), beside(path, "old")
    recover(spark, path)
    files.delete(old)
    if files.exists(path):
        files.rename(path, old)
    files.rename(new, path)
    files.delete(old)


def recover(spark: SparkSession, path: str) -> None:
    """After a swap that was killed between its two steps, the folder of before is put back."""
    files, old = Files(spark), beside(path, "old")
    if not files.exists(path) and files.exists(old):
        files.rename(old, path)
