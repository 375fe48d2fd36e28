"""Files that tasks write and read themselves, in the folder that all executors share."""

from __future__ import annotations

from pyarrow import fs


# Names that Spark has for stores which Arrow knows by another.
SCHEMES = {"s3a": "s3", "s3n": "s3", "wasbs": "abfss", "wasb": "abfs"}


def arrow_uri(uri: str) -> str:
    """The address as Arrow spells it; one under ``dbfs:`` is that of its mount."""
    scheme, colon, rest = uri.partition(":")
    if scheme == "dbfs" and colon:
        return "/dbfs/" + rest.lstrip("/")
    return f"{SCHEMES.get(scheme, scheme)}:{rest}" if colon else uri


def at(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI, or of an absolute local path."""
    return fs.FileSystem.from_uri(arrow_uri(uri))


def is_local(system: fs.FileSystem) -> bool:
    return isinstance(system, fs.LocalFileSystem)
