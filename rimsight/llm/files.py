"""Files of the operators in the shared folder, written and read by tasks through pyarrow's file systems."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs


def _at(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


@contextmanager
def whole_file(uri: str) -> Iterator:
    """A file that appears under its name only once it is complete.

    A task that runs twice, or is lost half way, leaves no partial file: the last to finish
    puts its equal copy in place.
    """
    system, path = _at(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    partial = f"{path}.{uuid.uuid4().hex}.partial"
    with system.open_output_stream(partial, compression=None) as out:
        yield out
    system.move(partial, path)


def open_file(uri: str):
    """Random access to a file, buffered by the caller."""
    system, path = _at(uri)
    return system.open_input_file(path)
