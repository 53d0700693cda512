"""Binary files in a folder that all executors reach, whatever file system it is on.

Paths come as ``operators.storage.qualified`` gives them: only one of the local file system, be it a disk
that all machines mount, goes without a scheme.
"""

from __future__ import annotations

import os
from urllib.parse import unquote, urlsplit

import numpy as np
import pyarrow as pa
from pyarrow import fs


def _local(uri: str) -> str | None:
    parts = urlsplit(uri)
    return unquote(parts.path) if parts.scheme in ("", "file") else None


def _remote(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def create(uri: str):
    """A new binary file for writing; missing folders are made."""
    if path := _local(uri):
        os.makedirs(os.path.dirname(path), exist_ok=True)
        return open(path, "wb")
    system, path = _remote(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    return system.open_output_stream(path)


def mapped(uri: str, dtype: str) -> np.ndarray:
    """The file as an array: memory-mapped where the file system is mounted, else read."""
    if path := _local(uri):
        return np.memmap(path, dtype, "r") if os.path.getsize(path) else np.empty(0, dtype)
    system, path = _remote(uri)
    with system.open_input_file(path) as file:
        data: pa.Buffer = file.read_buffer()
    return np.frombuffer(data, dtype)
