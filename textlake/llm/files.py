"""Binary files in the shared folder, written and read by tasks.

A task names its files anew in every attempt, and only files of tasks that succeed get into
the written list of files. So repeated or lost attempts leave files that nothing reads.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyarrow import fs


@contextmanager
def new_file(folder: str, suffix: str):
    """(path, stream) of a new file below the folder, a path or a URI."""
    system, root = fs.FileSystem.from_uri(folder)
    system.create_dir(root, recursive=True)
    name = f"{uuid.uuid4().hex}{suffix}"
    with system.open_output_stream(f"{root}/{name}", compression=None) as stream:
        yield f"{folder}/{name}", stream


def read_range(path: str, start: int = 0, size: int | None = None) -> bytes:
    system, place = fs.FileSystem.from_uri(path)
    with system.open_input_file(place) as file:
        size = file.size() - start if size is None else size
        return file.read_at(size, start)


def open_input(path: str):
    system, place = fs.FileSystem.from_uri(path)
    return system.open_input_file(place)
