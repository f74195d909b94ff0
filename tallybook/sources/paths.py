"""Folder listing and replacement through the Hadoop file system, so any shared storage works."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

_OLD = ".replaced-"
_NEW = ".writing-"


def _locate(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, location = _locate(spark, path)
    return fs.exists(location)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the visible sub-folders of ``path``, sorted; empty when it is missing."""
    fs, location = _locate(spark, path)
    if not fs.exists(location):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(location) if s.isDirectory()]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of all files and folders in ``path``, sorted; empty when it is missing."""
    fs, location = _locate(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(location)) if fs.exists(location) else []


def make_mark(spark: SparkSession, path: str) -> None:
    """An empty file."""
    fs, location = _locate(spark, path)
    fs.create(location, True).close()


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, location = _locate(spark, path)
    fs.delete(location, True)


def _beside(path: str, kind: str, tail: str = "") -> str:
    """A hidden folder next to ``path``, which listings of tables don't show."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/{kind}{name}-{tail}" if parent else f"{kind}{name}-{tail}"


def folder_for_writing(path: str) -> str:
    """A new hidden folder next to ``path``."""
    return _beside(path, _NEW, uuid.uuid4().hex)


def swap_folder(spark: SparkSession, path: str, fresh: str) -> None:
    """Put the folder ``fresh``, written whole, in the place of ``path``; the old one goes last.

    Two renames. If the second fails the old folder is put back at once; if the process dies in
    between, ``restore_folder`` does it later. Old rows are deleted only when the new ones stand.
    """
    restore_folder(spark, path)
    fs, goal = _locate(spark, path)
    _, new = _locate(spark, fresh)
    old = None
    if fs.exists(goal):
        _, old = _locate(spark, _beside(path, _OLD, uuid.uuid4().hex))
        if not fs.rename(goal, old):
            raise OSError(f"{path} can't be moved aside")
    done = False
    try:
        done = fs.rename(new, goal)
    finally:
        if not done and old is not None:
            fs.rename(old, goal)
    if not done:
        raise OSError(f"{fresh} can't be moved to {path}")
    if old is not None:
        fs.delete(old, True)


def restore_folder(spark: SparkSession, path: str) -> None:
    """Undo a replacement that died between its renames: the old folder comes back where none stands."""
    fs, goal = _locate(spark, path)
    parent = goal.getParent()
    if fs.exists(goal) or parent is None or not fs.exists(parent):
        return
    prefix = _beside(path, _OLD).rpartition("/")[2]
    left = [s.getPath() for s in fs.listStatus(parent) if s.getPath().getName().startswith(prefix)]
    exact = [p for p in left if len(p.getName()) == len(prefix) + 32]
    if exact:
        fs.rename(exact[0], goal)


def qualified_path(spark: SparkSession, path: str) -> str:
    """Path with scheme and host, as file names carry them; local ones with one slash."""
    fs, location = _locate(spark, path)
    return full_address(fs.makeQualified(location).toString())


def full_address(uri: str) -> str:
    return ("file:/" + uri[5:].lstrip("/") if uri.startswith("file:") else uri).rstrip("/")
