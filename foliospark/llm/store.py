"""Files in the shared folder, written and read by range from executors, on any store that pyarrow knows."""

from __future__ import annotations

import uuid
from functools import cache

from pyarrow import fs


@cache
def filesystem(scheme_and_host: str) -> fs.FileSystem:
    return fs.FileSystem.from_uri(scheme_and_host + "/")[0]


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it that a URI or an absolute local path names."""
    if "://" not in uri:
        return filesystem("file://"), uri.removeprefix("file:")
    scheme, rest = uri.split("://", 1)
    if scheme == "file":
        return filesystem("file://"), "/" + rest.lstrip("/")
    host, _, path = rest.partition("/")
    found, _ = fs.FileSystem.from_uri(uri)
    return (found, f"{host}/{path}") if scheme in ("s3", "gs", "gcs") else (found, "/" + path)


def create(folder: str, name: str):
    """An output stream for a new file of the folder and its URI. The name gets an own part for each attempt of a task."""
    where, path = locate(folder)
    where.create_dir(path, recursive=True)
    own = name.format(uuid.uuid4().hex)
    return where.open_output_stream(f"{path}/{own}"), f"{folder}/{own}"


class Ranges:
    """Range reads; the file read last stays open."""

    def __init__(self):
        self.uri, self.file = None, None

    def open(self, uri: str):
        if uri != self.uri:
            self.close()
            where, path = locate(uri)
            self.uri, self.file = uri, where.open_input_file(path)
        return self.file

    def read(self, uri: str, offset: int, length: int) -> bytes:
        data = self.open(uri).read_at(length, offset)
        if len(data) != length:
            raise EOFError(f"{uri} ends before {offset + length}")
        return data

    def size(self, uri: str) -> int:
        return self.open(uri).size()

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
        self.uri, self.file = None, None
