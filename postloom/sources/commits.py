"""One commit for all outputs of a run and the offset behind it.

A run writes each output into a hidden folder beside the published files. Then one manifest
is put in place by a rename: it names the files to move and to drop, and the offset and
ledger that hold from then on. That rename is the commit. Before it, nothing of the run
counts; after it, the next run finishes what is left of the moves, which can be repeated. So
outputs and offset never tell different stories, whichever step fails.

The folders need a file system whose renames are atomic, and one writer at a time.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

HOME, STAGED = "_commits", "_staged-"


@dataclass(frozen=True)
class Commit:
    """A committed run: the log it read, where it began and where the next one begins."""

    number: int = 0
    log: str = ""
    start: int = 0
    end: int = 0
    ledger: list = field(default_factory=list)


class Outputs:
    """The output folders that one run publishes together; the first keeps the manifests."""

    def __init__(self, spark: SparkSession, paths: list[str]):
        self.spark, self.paths = spark, paths
        self.home = f"{paths[0]}/{HOME}"

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self, path: str):
        return self._path(path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        files, at = self._files(folder), self._path(folder)
        return [s.getPath().getName() for s in files.listStatus(at)] if files.exists(at) else []

    def published(self, path: str) -> list[str]:
        """Data files of an output."""
        return [f"{path}/{n}" for n in self._names(path) if n[0] not in "_."]

    def _move(self, source: str, target: str) -> None:
        files = self._files(source)
        if files.exists(self._path(source)) and not files.rename(self._path(source), self._path(target)):
            raise OSError(f"{source} could not be moved to {target}")

    def _delete(self, path: str) -> None:
        self._files(path).delete(self._path(path), True)

    def _write(self, path: str, text: str) -> None:
        out = self._files(path).create(self._path(path), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def _read(self, path: str) -> dict:
        source = self._files(path).open(self._path(path))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8"))
        finally:
            source.close()

    def last(self) -> Commit:
        """The last committed run, after its moves are finished and what failed runs left is gone."""
        names = self._names(self.home)
        numbers = sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))
        made = Commit()
        if numbers:
            manifest = self._read(f"{self.home}/{numbers[-1]:08d}.json")
            made = Commit(numbers[-1], *(manifest[k] for k in ("log", "start", "end", "ledger")))
            if f"{made.number:08d}.done" not in names:
                self._finish(made.number, manifest)
        for path in self.paths:
            for name in self._names(path):
                if name.startswith(STAGED):
                    self._delete(f"{path}/{name}")
        return made

    def _finish(self, number: int, manifest: dict) -> None:
        for path in manifest["drops"]:
            self._delete(path)
        for source, target in manifest["moves"]:
            self._move(source, target)
        self._write(f"{self.home}/{number:08d}.done", "")

    def stage(self, path: str) -> str:
        """A folder to write this run's files of an output into."""
        return f"{path}/{STAGED}{uuid.uuid4().hex}"

    def publish(self, commit: Commit, staged: dict[str, str], replace: set[str]) -> None:
        """Make the staged files the outputs' next ones, in the order of their names; of the
        outputs to `replace`, the only ones."""
        moves, drops = [], []
        for path, folder in staged.items():
            names = sorted(n for n in self._names(folder) if n[0] not in "_.")
            moves += [[f"{folder}/{n}", f"{path}/run{commit.number:08d}-{n}"] for n in names]
            drops += self.published(path) if path in replace else []
        manifest = {
            "log": commit.log, "start": commit.start, "end": commit.end, "ledger": commit.ledger, "moves": moves, "drops": drops,
        }
        name = f"{self.home}/{commit.number:08d}"
        self._write(f"{name}.tmp", json.dumps(manifest))
        self._move(f"{name}.tmp", f"{name}.json")
        self._finish(commit.number, manifest)
        for folder in staged.values():
            self._delete(folder)
