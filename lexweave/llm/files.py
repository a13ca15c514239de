"""Binary files in the shared folder, written and read by tasks through Arrow's file systems."""

from __future__ import annotations

import posixpath
import uuid

from pyarrow import fs


def at(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI (file, hdfs, s3, gs ...) or of an absolute path."""
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


class Landing:
    """A file written under a name of its own attempt and moved to its final name when it is complete.

    A task that runs twice moves the same content twice; readers see only complete files.
    """

    def __init__(self, uri: str):
        self.system, self.path = at(uri)
        self.system.create_dir(posixpath.dirname(self.path), recursive=True)
        self.temporary = f"{posixpath.dirname(self.path)}/.{posixpath.basename(self.path)}.{uuid.uuid4().hex}"

    def __enter__(self):
        self.stream = self.system.open_output_stream(self.temporary)
        return self.stream

    def __exit__(self, kind, *_):
        self.stream.close()
        if kind is not None:
            self.system.delete_file(self.temporary)
            return
        try:
            self.system.move(self.temporary, self.path)
        except OSError:  # another attempt was first, on a file system that does not replace
            if self.system.get_file_info(self.path).type == fs.FileType.NotFound:
                raise
            self.system.delete_file(self.temporary)
