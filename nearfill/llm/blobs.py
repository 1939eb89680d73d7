"""Files that tasks write and read in the shared folder, local or remote, through pyarrow's file systems."""
from __future__ import annotations

import uuid

from pyarrow import fs


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def write(folder: str, name: str, parts: list[bytes]) -> str:
    """Write a new file; its name holds a random part, so that two attempts of a task never share one."""
    uri = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    system, path = _open(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(path) as out:
        for part in parts:
            out.write(part)
    return uri


def read(uri: str) -> bytes:
    system, path = _open(uri)
    with system.open_input_stream(path) as source:
        return source.readall()


def read_range(uri: str, start: int, size: int) -> bytes:
    """``size`` bytes from ``start``, without reading the rest."""
    system, path = _open(uri)
    with system.open_input_file(path) as source:
        return source.read_at(size, start)
