"""Files that Python workers write and read in the shared folder.

Paths are URIs of any file system that pyarrow opens. A file appears under its
name only when it is whole, and a task that runs again writes the same bytes, so
a lost executor or a second attempt does no harm.
"""

from __future__ import annotations

import uuid

import pyarrow.fs as pafs


def _open(uri: str):
    return pafs.FileSystem.from_uri(uri)


class Writer:
    """Streams bytes to ``uri``; the file is moved into place on a clean exit."""

    def __init__(self, uri: str):
        self.fs, self.path = _open(uri)
        folder, _, name = self.path.rpartition("/")
        self.fs.create_dir(folder, recursive=True)
        self.temporary = f"{folder}/.{name}.{uuid.uuid4().hex}"
        self.at = 0

    def __enter__(self):
        self.stream = self.fs.open_output_stream(self.temporary)
        return self

    def write(self, data: bytes) -> int:
        """The offset at which ``data`` begins."""
        at = self.at
        self.stream.write(data)
        self.at += len(data)
        return at

    def __exit__(self, kind, *_):
        self.stream.close()
        if kind is None:
            self.fs.move(self.temporary, self.path)
        else:
            self.fs.delete_file(self.temporary)


def reader(uri: str):
    """A seekable file and its size."""
    fs, path = _open(uri)
    return fs.open_input_file(path), fs.get_file_info(path).size


def remove_folder(uri: str) -> None:
    fs, path = _open(uri)
    if fs.get_file_info(path).type != pafs.FileType.NotFound:
        fs.delete_dir(path)
