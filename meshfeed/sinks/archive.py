"""Moving consumed input aside."""

from __future__ import annotations

from pyspark.sql import SparkSession

from meshfeed.session import hadoop_path


def archive_path(path: str) -> str:
    """``.../folder/name`` goes to ``.../folder/archive/name``."""
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/archive/{name}"


def require_free(spark: SparkSession, path: str, target: str | None = None) -> str:
    """The path that ``path`` would be archived to; an error if something is there already.

    For jobs that publish before they archive: better to fail before the first message.
    """
    target = target or archive_path(path)
    files, goal = hadoop_path(spark, target)
    if files.exists(goal):
        raise FileExistsError(target)
    return target


def move_to_archive(spark: SparkSession, path: str, target: str | None = None) -> str:
    """Rename a consumed file or directory into its sibling ``archive``; returns the new path.

    A rename in the file system, whatever the size. Nothing that is archived is overwritten.
    """
    target = require_free(spark, path, target)
    (files, source), (_, goal) = hadoop_path(spark, path), hadoop_path(spark, target)
    files.mkdirs(goal.getParent())
    if not files.rename(source, goal) or files.exists(source):
        raise OSError(f"could not move {path} to {target}")
    return target
