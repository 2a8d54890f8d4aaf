"""Files that tasks write to and read from the shared folder, by any file system."""

from __future__ import annotations


def open_folder(uri: str):
    """``(file system, path)`` of a folder URI such as Spark's checkpoint folder.

    Local paths and ``file:`` URIs use the local file system; other schemes use
    pyarrow's file system of that scheme.
    """
    from pyarrow import fs
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def open_file(uri: str):
    """A seekable reader for one file URI."""
    system, path = open_folder(uri)
    return system.open_input_file(path)


class NewFile:
    """A file that appears under its final name only when it is whole: written
    under a temporary name and renamed by ``commit``. A task that dies leaves
    nothing but a temporary file that no manifest names."""

    def __init__(self, folder: str, name: str):
        import uuid
        self._fs, root = open_folder(folder)
        self.uri = f"{folder}/{name}"
        self._final, self._temp = f"{root}/{name}", f"{root}/_{name}.{uuid.uuid4().hex}.tmp"
        self._fs.create_dir(root, recursive=True)
        self._out = self._fs.open_output_stream(self._temp)
        self.size = 0

    def write(self, data) -> None:
        self._out.write(data)
        self.size += len(data)

    def commit(self) -> None:
        self._out.close()
        self._fs.move(self._temp, self._final)
