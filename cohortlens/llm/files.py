"""Files that tasks write to and read from the shared folder.

A task writes under a name that only this attempt uses and reports the name as
its result; readers open the files that the job's stored result lists. An
attempt that was lost or ran twice leaves a file that nobody lists."""

from __future__ import annotations

import uuid

from pyarrow import fs


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address, and the path within it."""
    if path.startswith("file:/") and not path.startswith("file://"):  # as Hadoop writes it
        path = path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


def attempt_name(folder: str, part: int, suffix: str) -> str:
    return f"{folder}/{part:06d}-{uuid.uuid4().hex}{suffix}"


def create(path: str):
    """An output stream; missing folders are made."""
    where, inner = filesystem(path)
    where.create_dir(inner.rpartition("/")[0], recursive=True)
    return where.open_output_stream(inner, compression=None)  # the bytes as they are, whatever the name ends in


def open_stream(path: str):
    where, inner = filesystem(path)
    return where.open_input_stream(inner, compression=None)


def open_file(path: str):
    where, inner = filesystem(path)
    return where.open_input_file(inner)
