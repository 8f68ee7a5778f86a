"""Outputs published all at once: whole versions of a folder, and a mark that makes one current.

Every run writes its outputs into a version folder of its own, where nobody looks yet.
``publish`` renames one small mark into it; the version with the mark and the highest number
is the current one. No data is moved or deleted before that, so a run that fails at any point
leaves the version before it as it was, whole and readable, and readers never see a mixture.
Older versions go only after the next one is current, and the last ``keep`` always stay for
those who still read them.

The rename of one file to a new name is atomic on shared file systems and a single write on
object stores. Two runs at once write two versions; the one with the higher number, or the later
name, is current.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

FOLDER, MARK = "_versions", "current.json"


class Versions:
    """The versions of an output folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.base = f"{self.folder}/{FOLDER}"
        self.files = self.path_of(self.base).getFileSystem(spark._jsc.hadoopConfiguration())

    def path_of(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def names(self, complete: bool = True) -> list[str]:
        """Versions, the oldest first; with ``complete`` those that were published."""
        if not self.files.exists(self.path_of(self.base)):
            return []
        found = sorted(s.getPath().getName() for s in self.files.listStatus(self.path_of(self.base)) if s.isDirectory())
        return [n for n in found if not complete or self.files.exists(self.path_of(f"{self.base}/{n}/{MARK}"))]

    def begin(self) -> Version:
        last = max((int(n.split("-")[0]) for n in self.names(complete=False)), default=0)
        return Version(self, f"{last + 1:010d}-{uuid.uuid4().hex[:8]}")

    def outputs(self, name: str | None = None) -> dict[str, str]:
        """Path of every output of a version, by default the current one."""
        if name is None:
            published = self.names()
            if not published:
                raise FileNotFoundError(f"nothing has been published in {self.folder}")
            name = published[-1]
        held = self.spark.read.text(f"{self.base}/{name}/{MARK}", wholetext=True).first()[0]
        return {output: f"{self.base}/{name}/{output}" for output in json.loads(held)["outputs"]}

    def read(self, output: str, kind: str = "csv", **options) -> DataFrame:
        """An output of the current version."""
        return self.spark.read.format(kind).options(**options).load(self.outputs()[output])

    def drop_before(self, current: str, keep: int) -> None:
        """Remove the published versions older than the last ``keep`` up to ``current``.

        Unpublished ones may belong to runs still at work; ``drop_unpublished`` is for those.
        """
        published = [n for n in self.names() if n <= current]
        for name in published[:-keep]:
            self.files.delete(self.path_of(f"{self.base}/{name}"), True)

    def drop_unpublished(self) -> None:
        """Remove what failed runs left; only while no run is at work."""
        for name in set(self.names(complete=False)) - set(self.names()):
            self.files.delete(self.path_of(f"{self.base}/{name}"), True)


class Version:
    """One run's outputs, invisible until ``publish``."""

    def __init__(self, versions: Versions, name: str):
        self.versions, self.name = versions, name
        self.stage = f"{versions.base}/{name}"
        self.outputs: list[str] = []

    def path(self, output: str) -> str:
        self.outputs.append(output)
        return f"{self.stage}/{output}"

    def publish(self, keep: int = 2) -> dict[str, str]:
        """Make this version current; gives the path of every output."""
        versions, path_of = self.versions, self.versions.path_of
        missing = [o for o in self.outputs if not versions.files.exists(path_of(f"{self.stage}/{o}"))]
        if missing:
            raise OSError(f"not written: {', '.join(missing)}")
        draft, mark = path_of(f"{self.stage}/{MARK}.draft"), path_of(f"{self.stage}/{MARK}")
        stream = versions.files.create(draft, True)
        try:
            stream.write(bytearray(json.dumps({"outputs": self.outputs}).encode()))
        finally:
            stream.close()
        if not versions.files.rename(draft, mark):
            raise OSError(f"{self.name} cannot be published in {versions.folder}")
        versions.drop_before(self.name, keep)
        return {o: f"{self.stage}/{o}" for o in self.outputs}
