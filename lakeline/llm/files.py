"""Binary files in the shared folder, written and read inside tasks.

A task writes under a name of its own and reports it in its output rows. Only what a manifest table
names counts, so files of failed or doubled attempts are never read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs


def _place(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path if "://" in path else "file://" + path[5:])
    return fs.LocalFileSystem(), path


def new_name(folder: str, ending: str) -> str:
    return f"{folder}/{uuid.uuid4().hex}.{ending}"


@contextmanager
def writing(path: str) -> Iterator:
    place, name = _place(path)
    place.create_dir(name.rpartition("/")[0], recursive=True)
    with place.open_output_stream(name, compression=None) as file:
        yield file


@contextmanager
def reading(path: str) -> Iterator:
    place, name = _place(path)
    with place.open_input_file(name) as file:
        yield file
