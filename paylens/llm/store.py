"""Numpy arrays in the shared folder, written by tasks and memory-mapped by workers."""

from __future__ import annotations

import io
import os
import shutil
import tempfile
import uuid

import numpy as np

MAPS = 8192  # open at a time; the kernel's usual limit for a process is 65,530


class Store:
    """Arrays in the shared folder, by name."""

    def __init__(self, uri: str):
        self.uri = uri

    def _open(self):
        from pyarrow import fs

        if self.uri.startswith("file:"):
            return fs.LocalFileSystem(), "/" + self.uri.removeprefix("file:").lstrip("/")
        if "://" in self.uri:
            return fs.FileSystem.from_uri(self.uri)
        return fs.LocalFileSystem(), self.uri

    def write(self, name: str, **arrays: np.ndarray) -> None:
        """Each array under its name, complete or not at all.

        A repeated task writes the same content, so the first complete file is as good as any.
        """
        files, folder = self._open()
        for key, array in arrays.items():
            files.create_dir(f"{folder}/{key}")
            data = io.BytesIO()
            np.save(data, array)
            part = f"{folder}/{key}/.{name}-{uuid.uuid4().hex}"
            with files.open_output_stream(part) as out:
                out.write(data.getbuffer())
            target = f"{folder}/{key}/{name}.npy"
            if files.get_file_info(target).is_file:
                files.delete_file(part)
            else:
                files.move(part, target)

    def reader(self) -> Reader:
        return Reader(*self._open())


class Reader:
    """Memory-mapped arrays, the least recently used unmapped beyond ``MAPS``.

    Copies of remote ones are removed when done.
    """

    def __init__(self, files, folder: str):
        from pyarrow import fs

        self.files, self.folder = files, folder
        self.copies = None if isinstance(files, fs.LocalFileSystem) else tempfile.mkdtemp()
        self.open: dict[str, np.ndarray] = {}

    def __call__(self, key: str, name: str) -> np.ndarray:
        path = f"{self.folder}/{key}/{name}.npy"
        array = self.open.pop(path, None)
        if array is None:
            local = path
            if self.copies:
                local = f"{self.copies}/{key}-{name}.npy"
                if not os.path.exists(local):
                    with self.files.open_input_stream(path) as source, open(local, "wb") as out:
                        shutil.copyfileobj(source, out)
            array = np.load(local, mmap_mode="r")
        self.open[path] = array  # last in order: used last
        if len(self.open) > MAPS:
            del self.open[next(iter(self.open))]
        return array

    def close(self) -> None:
        self.open.clear()
        if self.copies:
            shutil.rmtree(self.copies, ignore_errors=True)
