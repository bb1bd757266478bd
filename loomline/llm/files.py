"""Binary files in the shared folder, written and read by tasks.

A task writes below a name of its own attempt and reports the name as a row; only reported files are read. So a
task that is run again, after a lost executor or as a speculative copy, leaves files that nothing refers to.
"""

from __future__ import annotations

import re
import uuid
from typing import IO

from pyarrow import fs


def resolved(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of ``uri`` and the path within it; file:/a and /a mean file:///a, s3a: means s3:."""
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", re.sub(r"^file:/+|^/+", "file:///", uri)))


def attempt_name(folder: str, suffix: str) -> str:
    return f"{folder}/{uuid.uuid4().hex}{suffix}"


def create(uri: str) -> IO[bytes]:
    system, path = resolved(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return system.open_output_stream(path, compression=None)


def open_at(uri: str) -> IO[bytes]:
    """A file to seek and read in."""
    system, path = resolved(uri)
    return system.open_input_file(path)


def remove(folder: str) -> None:
    system, path = resolved(folder)
    if system.get_file_info(path).type != fs.FileType.NotFound:
        system.delete_dir(path)
