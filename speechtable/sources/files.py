"""File access that works in tasks as on the driver, for local, S3, GCS and HDFS paths."""

from __future__ import annotations

from pyarrow import fs


def locate(path: str) -> tuple[fs.FileSystem, str]:
    """(file system, path inside it) of a path or URI; s3a:// and s3n:// are S3."""
    for alias in ("s3a://", "s3n://"):
        if path.startswith(alias):
            path = "s3://" + path[len(alias):]
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def info(path: str) -> fs.FileInfo:
    system, inner = locate(path)
    return system.get_file_info(inner)


def plain(path: str) -> str:
    """A Hadoop file URI as the local path it stands for; other URIs as they are."""
    return "/" + path[len("file:"):].lstrip("/") if path.startswith("file:") else path


def full(uri: str, root: str, inner: str) -> str:
    """URI of ``inner``, a path of the file system in which ``uri`` stands for ``root``."""
    uri, root = uri.rstrip("/"), root.rstrip("/")
    return uri[: len(uri) - len(root)] + inner if uri.endswith(root) else inner
