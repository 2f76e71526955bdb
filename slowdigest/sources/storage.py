"""Folders of a table that hold whole versions, on any file system Spark can reach.

``v=<n>`` holds one version.  ``r=<a>-<b>-<g>`` holds versions a to b at once, in its g-th writing: it takes the
place of every folder inside its range, and of its own earlier writings.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.sql import Observation, SparkSession

_NAME = re.compile(r"v=(\d+)|r=(\d+)-(\d+)-(\d+)")


@dataclass(frozen=True, order=True)
class Run:
    first: int
    last: int
    generation: int

    @property
    def name(self) -> str:
        alone = self.first == self.last and not self.generation
        return f"v={self.first}" if alone else f"r={self.first}-{self.last}-{self.generation}"

    def within(self, other: Run) -> bool:
        """Whether ``other`` takes the place of this one."""
        if (self.first, self.last) == (other.first, other.last):
            return self.generation < other.generation
        return other.first <= self.first and self.last <= other.last

    def next(self) -> Run:
        return Run(self.first, self.last, self.generation + 1)


def _open(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, pattern: str) -> bool:
    files, path = _open(spark, pattern)
    return bool(files.globStatus(path))


def version_path(root: str, version: int) -> str:
    return f"{root}/v={version}"


def committed_runs(spark: SparkSession, root: str) -> list[Run]:
    """Folders whose write finished, by one listing; a half-written one has no ``_SUCCESS``."""
    files, done = _open(spark, f"{root}/*/_SUCCESS")
    found = []
    for status in files.globStatus(done) or ():
        m = _NAME.fullmatch(status.getPath().getParent().getName())
        if m:
            found.append(Run(int(m[1]), int(m[1]), 0) if m[1] else Run(int(m[2]), int(m[3]), int(m[4])))
    return sorted(found)


def cover(runs: list[Run]) -> list[Run]:
    """The runs that no other one replaces."""
    return [r for r in runs if not any(r.within(other) for other in runs)]


def committed_versions(spark: SparkSession, root: str) -> list[int]:
    """Single versions whose write finished, ascending."""
    return [r.first for r in committed_runs(spark, root) if r.name.startswith("v=")]


def observed(counts: Observation) -> dict[str, int]:
    """What an observation saw of a finished write; nothing if the plan was known to be empty."""
    try:
        return counts.get
    except Py4JJavaError:
        # Such a plan is optimised away, its counts included.
        return {}


def stored_bytes(spark: SparkSession, root: str, runs: list[Run]) -> int:
    total = 0
    for run in runs:
        files, folder = _open(spark, f"{root}/{run.name}")
        total += files.getContentSummary(folder).getLength()
    return total


def drop_run(spark: SparkSession, root: str, run: Run) -> None:
    files, folder = _open(spark, f"{root}/{run.name}")
    files.delete(folder, True)


def create_once(spark: SparkSession, path: str, write: Callable[[str], None]) -> bool:
    """Let ``write`` make the folder ``path`` unless it is there; whether this call made it.

    The folder is written elsewhere and renamed, which the file system does for one caller only: where the
    name is taken, a rename fails or moves the folder below the one that is there, and it is removed.  Holds for
    file systems whose renames are atomic, which object stores without them are not.
    """
    own = f"_own-{uuid.uuid4().hex}"
    aside = f"{path}{own}"
    write(aside)
    files, source = _open(spark, aside)
    _, target = _open(spark, path)
    if files.exists(target):
        files.delete(source, True)
        return False
    files.rename(source, target)
    _, below = _open(spark, f"{path}/{source.getName()}")
    lost = files.exists(below) or files.exists(source)
    for left in (below, source):
        files.delete(left, True)
    return not lost


def forget_commit(spark: SparkSession, checkpoint: str, batch: int) -> None:
    """Take back the commit of a stream's batch, as if it had been lost: the batch then runs again."""
    for name in (f"{batch}", f".{batch}.crc"):
        files, path = _open(spark, f"{checkpoint}/commits/{name}")
        files.delete(path, False)
