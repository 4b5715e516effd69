"""File access from inside tasks (pyarrow.fs: local paths, file: URIs, HDFS, object stores)."""

from __future__ import annotations

import re


def filesystem(root: str):
    """(filesystem, path) for a local path, a 'file:' URI or any URI pyarrow understands; other
    schemes raise ``ValueError``. Jobs call this on the driver before they start."""
    from pyarrow import fs

    root = re.sub(r"^s3[an]://", "s3://", root)  # Hadoop's names of the same store

    if root.startswith("file:"):
        return fs.LocalFileSystem(), "/" + re.sub(r"^file:/*", "", root)
    if re.match(r"^[a-zA-Z][a-zA-Z0-9+.-]*://", root):
        try:
            return fs.FileSystem.from_uri(root)
        except ValueError as e:  # ArrowInvalid: no such scheme
            raise ValueError(f"no file system for {root!r}: {e}") from e
    return fs.LocalFileSystem(), root


def uri_prefix(root: str) -> str:
    """What stands before a path listed under ``root`` to make it a full URI: '' for local paths,
    'hdfs://host:port' where listed paths begin with a slash, 's3a://' where they begin with the bucket."""
    found = re.match(r"^([a-zA-Z][a-zA-Z0-9+.-]*)://([^/]*)", root)
    if not found or found.group(1) == "file":
        return ""
    _, path = filesystem(root)
    return found.group(0) if path.startswith("/") else found.group(1) + "://"


def read_bytes(path: str) -> bytes:
    """The whole file at ``path`` (as listed by Spark's binaryFile source)."""
    filesystem_, p = filesystem(path)
    with filesystem_.open_input_stream(p) as fh:
        return fh.read()
