"""Tables as version directories and a pointer that names the current one.

``path/version-<id>`` holds data and ``path/_current/<number>.version-<id>`` is an empty file; the highest
number is the current version. Creating an empty file is atomic on every store, so readers see the old
version or the new one, never none and never half. A failed write leaves an unnamed directory that nobody reads.
One writer at a time is assumed: two that commit the same number fail. A version may lie elsewhere: ``place`` then gives
the directory of a version's name.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from tallyloom.session import filesystem, path_exists, remove_path

KEPT = 2


def fresh(path: str) -> str:
    """Path for a new version, not yet visible."""
    return f"{path}/version-{uuid.uuid4().hex}"


def _pointers(spark: SparkSession, path: str) -> list[str]:
    fs, folder = filesystem(spark, f"{path}/_current")
    if not fs.exists(folder):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(folder))


def exists(spark: SparkSession, path: str) -> bool:
    return bool(_pointers(spark, path))


def current(spark: SparkSession, path: str, place: Callable[[str], str] | None = None) -> str:
    """Directory of the current version."""
    named = _pointers(spark, path)
    if not named:
        raise LookupError(f"no version of {path}")
    name = named[-1].partition(".")[2]
    return place(name) if place else f"{path}/{name}"


def commit(spark: SparkSession, path: str, version: str, place: Callable[[str], str] | None = None) -> None:
    """Make a finished version current and remove all but the latest ``KEPT``, so running readers keep theirs."""
    named = _pointers(spark, path)
    number = int(named[-1].partition(".")[0]) + 1 if named else 0
    fs, pointer = filesystem(spark, f"{path}/_current/{number:012d}.{version.rsplit('/', 1)[1]}")
    if any(n.startswith(f"{number:012d}.") for n in _pointers(spark, path)) or not fs.createNewFile(pointer):
        raise OSError(f"another writer committed {path}")
    for name in named[: 1 - KEPT]:
        old = name.partition(".")[2]
        remove_path(spark, place(old) if place else f"{path}/{old}")
        remove_path(spark, f"{path}/_current/{name}")


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the directories below ``path``."""
    if not path_exists(spark, path):
        return []
    fs, folder = filesystem(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory() and not s.getPath().getName().startswith("_"))
