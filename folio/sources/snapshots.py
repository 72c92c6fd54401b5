"""Snapshots of a folder of tables: immutable data folders, and numbered manifests that name them.

A writer puts data into new folders only and then switches by adding one manifest
(written under a temporary name, then renamed; a rename never replaces a file).
Until then readers see the last snapshot, and a writer that dies leaves folders
that no manifest names.  A reader that holds a snapshot keeps it until `expire`
removes it.  Paths go through Hadoop's file systems, so any store that Spark
reads will do.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import SparkSession


class Snapshots:
    """The manifests under ``root`` (``root/manifests/0000000000.json``, ...)."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._gateway = spark.sparkContext._gateway
        self._hadoop = self._jvm.org.apache.hadoop.fs
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, below: str):
        return self._hadoop.Path(f"{self.root}/{below}" if below else self.root)

    def names(self, below: str) -> list[str]:
        """What lies directly in a sub-folder (nothing if there is none)."""
        path = self._path(below)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path)) if self._fs.exists(path) else []

    def numbers(self) -> list[int]:
        return [int(m[1]) for m in (re.fullmatch(r"(\d{10})\.json", n) for n in self.names("manifests")) if m]

    def read(self, number: int | None = None) -> tuple[int, dict] | None:
        """(number, manifest) of a snapshot, the newest by default; None if there is none yet."""
        known = self.numbers()
        if number is None and not known:
            return None
        if number is not None and number not in known:
            raise ValueError(f"{self.root} has no snapshot {number}")
        number = known[-1] if number is None else number
        stream = self._fs.open(self._path(f"manifests/{number:010d}.json"))
        try:
            return number, json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def folder(self, table: str, number: int) -> str:
        """A new data folder (relative to the root) for the snapshot that is being written."""
        return f"{table}/commit={number:010d}-{uuid.uuid4().hex[:8]}"

    def commit(self, number: int, manifest: dict) -> None:
        """Make ``manifest`` the newest snapshot; an error if another writer has added this number."""
        temporary, final = self._path(f"manifests/_{uuid.uuid4().hex}"), self._path(f"manifests/{number:010d}.json")
        out = self._fs.create(temporary)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        context = self._hadoop.FileContext.getFileContext(self._fs.getUri(), self._conf)
        no_options = self._gateway.new_array(getattr(self._hadoop, "Options$Rename"), 0)
        try:
            context.rename(self._fs.makeQualified(temporary), self._fs.makeQualified(final), no_options)
        except Exception as e:
            self._fs.delete(temporary, False)
            raise RuntimeError(f"snapshot {number} of {self.root} was written by another writer") from e

    def expire(self, tables: list[str], folders_of, keep: int = 1) -> None:
        """Keep the newest ``keep`` manifests; delete older ones and every data folder that none of the kept ones names.

        ``folders_of(manifest)`` gives its data folders.  Not while a writer is at work, nor for snapshots still read."""
        numbers = self.numbers()
        kept = set()
        for n in numbers[-keep:]:
            kept |= set(folders_of(self.read(n)[1]))
        for n in numbers[:-keep]:
            self._fs.delete(self._path(f"manifests/{n:010d}.json"), False)
        for t in tables:
            for commit in self.names(t):
                if f"{t}/{commit}" in kept:
                    continue
                parts = [f"{t}/{commit}/{p}" for p in self.names(f"{t}/{commit}")]
                if not any(p in kept for p in parts):
                    self._fs.delete(self._path(f"{t}/{commit}"), True)
                    continue
                for p in parts:
                    if "=" in p.rsplit("/", 1)[-1] and p not in kept:
                        self._fs.delete(self._path(p), True)
