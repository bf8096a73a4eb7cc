"""Binary files that tasks write and read in the folder all executors share."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


@contextmanager
def publish(uri: str) -> Iterator:
    """A stream to write `uri` with. The file appears whole or not at all, however often a task is run again."""
    system, path = locate(uri)
    folder, name = posixpath.split(path)
    system.create_dir(folder, recursive=True)
    draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(draft, compression=None) as out:
        yield out
    try:
        system.move(draft, path)
    except OSError:
        if system.get_file_info(path).type != fs.FileType.File:
            raise
        system.delete_file(draft)  # another attempt of this task was first


def random_access(uri: str):
    system, path = locate(uri)
    return system.open_input_file(path)


def sequential(uri: str):
    system, path = locate(uri)
    return system.open_input_stream(path, compression=None)
