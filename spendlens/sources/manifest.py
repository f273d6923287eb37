"""Datasets whose state is one small committed file.

Data folders are written under new names and never changed. A manifest names the folders that
count; committing the next one is a rename within the dataset, so readers see the old state or the
new one and a writer that fails leaves folders that nobody reads. A writer that finds its number
taken by another raises ``Conflict``; nothing of it shows and it can start again from the new state.

A rename that doesn't replace (HDFS, most table stores' committers) makes this safe for several
writers; where a rename may replace, as on a local disk, run one writer per dataset.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class Conflict(RuntimeError):
    """Another writer has committed since this one read the manifest."""


class Manifest:
    """Numbered states of the dataset under ``root``; a state is a JSON object."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._at = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        self._fs = self._at.getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def names(self, folder: str) -> list[str]:
        """Names in a folder of the dataset; none if there is no such folder."""
        at = self._path(folder)
        return [f.getPath().getName() for f in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def numbers(self) -> list[int]:
        return sorted(int(n.split(".")[0]) for n in self.names("_manifests") if n.endswith(".json") and n[0].isdigit())

    def read(self, number: int | None = None) -> tuple[int, dict]:
        """A state and its number, the newest by default; (0, {}) before the first."""
        if number is None:
            number = max(self.numbers(), default=0)
        if not number:
            return 0, {}
        stream = self._fs.open(self._path(f"_manifests/{number:012d}.json"))
        try:
            return number, json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def commit(self, number: int, state: dict) -> None:
        """Make ``state`` the one after ``number``."""
        draft, final = self._path(f"_manifests/_draft-{uuid.uuid4().hex}"), self._path(f"_manifests/{number + 1:012d}.json")
        stream = self._fs.create(draft, False)
        try:
            stream.write(bytearray(json.dumps(state).encode()))
        finally:
            stream.close()
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            self._fs.delete(draft, False)
            raise Conflict(f"{self.root}: state {number + 1} has been committed by another writer")

    def new_folder(self) -> str:
        """A name for a data folder that nobody has."""
        return f"write_id={uuid.uuid4().hex}"

    def data(self, folder: str) -> str:
        return f"{self.root}/data/{folder}"

    def vacuum(self, used, keep: int = 2) -> list[str]:
        """Remove states before the newest ``keep`` and data folders that the kept ones don't use.

        ``used(state)`` gives a state's folders. Readers of a removed state fail, so keep as many as
        may still be read; run it while no write is under way.
        """
        numbers = self.numbers()
        kept = numbers[-keep:]
        folders = {f for n in kept for f in used(self.read(n)[1])}
        gone = [f for f in self.names("data") if f not in folders]
        for n in numbers[:-keep]:
            self._fs.delete(self._path(f"_manifests/{n:012d}.json"), False)
        for f in gone:
            self._fs.delete(self._path(f"data/{f}"), True)
        return gone
