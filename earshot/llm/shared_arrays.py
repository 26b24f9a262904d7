"""Arrays as files of the shared folder, written by tasks and memory-mapped by others."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyarrow import fs


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def put(folder: str, name: str, array: np.ndarray) -> None:
    """Write an array; the file appears whole, so that a repeated task replaces it by its equal."""
    store, path = _place(folder)
    store.create_dir(path, recursive=True)
    draft = f"{path}/.{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(draft) as out:
        out.write(np.ascontiguousarray(array).tobytes())
    store.move(draft, f"{path}/{name}")


def get(folder: str, name: str, dtype: type) -> np.ndarray:
    """Map an array; from a store that is no local path by way of an unnamed copy."""
    store, path = _place(folder)
    if not store.get_file_info(f"{path}/{name}").size:
        return np.zeros(0, dtype)
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(f"{path}/{name}", dtype, "r")
    with tempfile.TemporaryFile() as copy, store.open_input_stream(f"{path}/{name}") as source:
        while block := source.read(1 << 22):
            copy.write(block)
        copy.flush()
        return np.memmap(copy, dtype, "r")
