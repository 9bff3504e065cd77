"""Numpy arrays that tasks write to the shared folder and that workers memory-map."""

from __future__ import annotations

import io
import os
import tempfile
import uuid

import numpy as np
from pyarrow import fs


def _place(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if ":" in folder else "file://" + folder)


def write_array(folder: str, name: str, values: np.ndarray) -> None:
    """Write one array. A task that runs again writes the same file again, and readers
    never see half of one."""
    system, path = _place(folder)
    system.create_dir(path, recursive=True)
    held = io.BytesIO()
    np.save(held, values)
    part = f"{path}/.{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(part) as out:
        out.write(held.getbuffer())
    system.move(part, f"{path}/{name}.npy")


class SharedArrays:
    """Arrays of one folder, mapped into memory when first used. From a store that is
    not a file system, each worker fetches those it uses; a file that is fetched has no
    name any more once it is mapped, so it goes with the worker."""

    def __init__(self, folder: str):
        self.folder = folder
        self.open: dict[str, np.ndarray] = {}

    def __getitem__(self, name: str) -> np.ndarray:
        if name not in self.open:
            system, path = _place(self.folder)
            file = f"{path}/{name}.npy"
            if not isinstance(system, fs.LocalFileSystem):
                with tempfile.TemporaryDirectory() as fetched:
                    copy = os.path.join(fetched, f"{name}.npy")
                    fs.copy_files(file, copy, source_filesystem=system, destination_filesystem=fs.LocalFileSystem())
                    self.open[name] = np.load(copy, mmap_mode="r")
            else:
                self.open[name] = np.load(file, mmap_mode="r")
        return self.open[name]

    def __getstate__(self):
        return {"folder": self.folder, "open": {}}
