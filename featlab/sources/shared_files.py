"""Files of a shared folder from Python tasks: local, HDFS or object store paths as Spark names them."""

from __future__ import annotations

import os

import numpy as np
from pyarrow import fs


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """(file system, path) of a folder given as Spark gives it (``file:/...``, ``hdfs://...``, a plain path)."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), os.path.abspath(uri)
    return fs.FileSystem.from_uri(uri)


def put(uri: str, name: str, chunks, attempt: str) -> None:
    """Write ``chunks`` (bytes-like) as ``name``; complete or absent, and a
    repeated attempt replaces the file with the same bytes."""
    files, folder = open_folder(uri)
    files.create_dir(folder, recursive=True)
    part = f"{folder}/.{name}.{attempt}"
    with files.open_output_stream(part) as out:
        for c in chunks:
            out.write(c)
    files.move(part, f"{folder}/{name}")


def get_array(uri: str, name: str, dtype) -> np.ndarray:
    """A flat array file: memory-mapped where the folder is a mounted path, else read."""
    files, folder = open_folder(uri)
    path = f"{folder}/{name}"
    size = files.get_file_info(path).size
    if not size:
        return np.zeros(0, dtype)
    if isinstance(files, fs.LocalFileSystem):
        return np.memmap(path, dtype=dtype, mode="r")
    with files.open_input_file(path) as f:
        return np.frombuffer(f.read_buffer(size), dtype=dtype)


def drop(uri: str) -> None:
    """Remove a folder of scratch files that are not read again, if it is there."""
    files, folder = open_folder(uri)
    if files.get_file_info(folder).type != fs.FileType.NotFound:
        files.delete_dir(folder)
