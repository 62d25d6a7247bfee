"""What the stages of the job have written, one small file for each source, mart and table.

An entry is written as soon as its folder is complete and names the input it was made from. So a stage
that was ended half-way goes on where it ended: what is complete and made from the present input is
left alone. The next stage goes by the entries and not by the folders it finds, so folders that
an earlier run left behind are never taken for those of the present one.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable
from dataclasses import asdict, dataclass
from uuid import uuid4

from pyspark.sql import SparkSession

from paylens.operators.folders import Files

Rows = dict[str, int | None]
SUFFIX = ".json"


@dataclass(frozen=True)
class Entry:
    """Rows written (None: nothing, as an optional input is missing), rows read and counts, if taken.

    ``input`` names what it was made from and ``id`` this very result.
    """

    input: str
    rows: int | None
    rows_read: int | None = None
    counts: dict[str, int] | None = None
    id: str = ""

    @classmethod
    def of(cls, input: str, rows: int | None, **more) -> Entry:
        return cls(input, rows, id=uuid4().hex, **more)


def identity(parts: Iterable[object]) -> str:
    """One name for all parts of an input."""
    return hashlib.sha256(json.dumps(list(parts)).encode()).hexdigest()


class Manifest:
    """The entries of one stage."""

    def __init__(self, spark: SparkSession, folder: str, stage: str):
        self._files, self._folder = Files(spark), f"{folder}/manifest/{stage}"

    def _path(self, name: str) -> str:
        return f"{self._folder}/{name}{SUFFIX}"

    def get(self, name: str) -> Entry | None:
        path = self._path(name)
        return Entry(**json.loads(self._files.read_text(path))) if self._files.exists(path) else None

    def entries(self) -> dict[str, Entry]:
        names = [n.removesuffix(SUFFIX) for n in self._files.names(self._folder)
                 if n.endswith(SUFFIX) and not n.startswith(("_", "."))]
        return {name: self.get(name) for name in names}

    def put(self, name: str, entry: Entry) -> Entry:
        self._files.write_text(self._path(name), json.dumps(asdict(entry)))
        return entry

    def drop(self, name: str) -> None:
        """Called before the folder of an entry is changed."""
        self._files.delete(self._path(name))

    def current(self, name: str, input: str) -> Entry | None:
        """The entry, if it was made from this input."""
        entry = self.get(name)
        return entry if entry and entry.input == input else None
