"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str = "local[*]", app: str = "wattline", **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    A cluster sets ``spark.sql.shuffle.partitions`` itself, and generously: AQE coalesces small
    partitions and splits skewed ones. Only a local master gets a small number here.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master.startswith("local"):
        builder = builder.config("spark.sql.shuffle.partitions", "8")
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; one is made here only if unset.

    A machine-local folder is made only for a local master: executors on other hosts could not
    read it.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_KEY, None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="wattline-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; nothing is written here yet."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def _place(spark: SparkSession, path: str):
    """A path and the file system that it lies in."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def restore_dir(spark: SparkSession, path: str) -> None:
    """Put back the folder that a replacement had taken away when it was stopped half way."""
    place, files = _place(spark, path)
    if files.exists(place):
        return
    kept = files.globStatus(place.suffix(".old-*")) or []
    if len(kept):
        newest = max(kept, key=lambda status: status.getModificationTime())
        if not files.rename(newest.getPath(), place):
            raise OSError(f"{newest.getPath()} could not be put back as {path}")


def replace_dir(spark: SparkSession, path: str, fresh: str) -> None:
    """Let a finished folder take the place of another one, which goes last.

    Two renames, so that ``path`` always names a whole table but for the moment between them; a job that
    ends in that moment leaves the old table beside it, and ``restore_dir`` puts it back.
    """
    place, files = _place(spark, path)
    old = place.suffix(f".old-{uuid.uuid4().hex}")
    there = files.exists(place)
    if there and not files.rename(place, old):
        raise OSError(f"{path} could not be moved away")
    if not files.rename(_place(spark, fresh)[0], place):
        restore_dir(spark, path)
        raise OSError(f"{fresh} could not be moved to {path}")
    for status in files.globStatus(place.suffix(".old-*")) or []:
        files.delete(status.getPath(), True)


def names_below(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """What follows the prefix in the names of the folders of ``path`` that begin with it, in order."""
    place, files = _place(spark, path)
    found = (status.getPath().getName() for status in (files.listStatus(place) if files.exists(place) else []))
    return sorted(name.removeprefix(prefix) for name in found if name.startswith(prefix))


def publish_dir(spark: SparkSession, fresh: str, path: str) -> None:
    """Give a finished folder its name, by one rename; a folder of that name must not be there."""
    place, files = _place(spark, path)
    if files.exists(place) or not files.rename(_place(spark, fresh)[0], place):
        raise OSError(f"{fresh} could not be moved to {path}")


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever it lies; one that is not there is fine."""
    place, files = _place(spark, path)
    files.delete(place, True)


@contextmanager
def scratch_dir(spark: SparkSession, label: str) -> Iterator[str]:
    """A new path below the shared folder, removed at the end of the block, also if that fails.

    What is read from it must be written elsewhere by then.
    """
    path = fresh_dir(spark, label)
    try:
        yield path
    finally:
        remove_dir(spark, path)
