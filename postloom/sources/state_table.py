"""State rows as a table with versions.

A run reads a version, and merges the rows of its tasks into it. Keys are dealt by a hash into
parts; a version is a manifest that names the folder of each part, so a merge rewrites only
parts that it has rows for. The manifest is put in place by a rename that fails if the
next version is there already: of two runs that read the same version, the second one to
write gets `StaleVersion` and has to read again, and nothing is overwritten.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


class StaleVersion(RuntimeError):
    """Another run has written since this one read."""


class StateTable:
    """Rows with a single-column key under `path`; `schema` has the key column."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str = "task_name", parts: int = 16):
        self.spark, self.path, self.schema, self.key, self.parts = spark, path, schema, key, parts
        self._hadoop = spark._jvm.org.apache.hadoop.fs

    def _path(self, path: str):
        return self._hadoop.Path(path)

    def _files(self):
        return self._path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _name(self, version: int) -> str:
        return f"{self.path}/versions/{version:010d}.json"

    def _part(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.parts)).cast("int")

    def version(self) -> int:
        """The newest version; 0 before the first one."""
        files, at = self._files(), self._path(f"{self.path}/versions")
        names = [s.getPath().getName() for s in files.listStatus(at)] if files.exists(at) else []
        return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json")), default=0)

    def _folders(self, version: int) -> dict[str, str]:
        """The folder of each part that has rows."""
        if version == 0:
            return {}
        source = self._files().open(self._path(self._name(version)))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8"))
        finally:
            source.close()

    def _rows(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def read(self, version: int | None = None) -> tuple[DataFrame, int]:
        """The rows of a version, and its number for the merge that follows."""
        version = self.version() if version is None else version
        return self._rows(list(self._folders(version).values())), version

    def merge(self, changes: DataFrame, version: int) -> int:
        """Put one row per key in place of the one that version `version` has; the new version.

        A key that comes twice in `changes` is an error, as either row would be a guess.
        """
        if version < self.version():
            raise StaleVersion(f"version {version} of {self.path} is not the newest")
        before, fresh = self._folders(version), f"{self.path}/data/{uuid.uuid4().hex}"
        columns = [f.name for f in self._rows([]).schema]
        dealt = changes.select(*columns).withColumn("_part", self._part())
        counts = dealt.groupBy("_part").agg(F.count("*").alias("n"), F.count_distinct(self.key).alias("keys")).collect()
        if any(r.n != r["keys"] for r in counts):
            raise ValueError(f"a {self.key} comes twice, or not at all, in the changes")
        touched = [str(r["_part"]) for r in counts]
        old = self._rows([before[p] for p in touched if p in before])
        kept = old.join(changes.select(self.key), self.key, "left_anti").select(*columns).withColumn("_part", self._part())
        kept.unionByName(dealt).repartition("_part").write.partitionBy("_part").parquet(fresh)
        folders = before | {p: f"{fresh}/_part={p}" for p in touched}
        self._commit(version + 1, json.dumps(folders))
        return version + 1

    def _commit(self, version: int, text: str) -> None:
        target, draft = self._path(self._name(version)), self._path(f"{self.path}/drafts/{uuid.uuid4().hex}")
        files = self._files()
        files.mkdirs(target.getParent())
        out = files.create(draft, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        context = self._hadoop.FileContext.getFileContext(
            files.makeQualified(draft).toUri(), self.spark._jsc.hadoopConfiguration()
        )
        # Without the option to overwrite, a rename to a name that is taken fails.
        plain = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(files.makeQualified(draft), files.makeQualified(target), plain)
        except Exception as error:
            if "FileAlreadyExists" not in str(error):
                raise
            files.delete(draft, False)
            raise StaleVersion(f"version {version} of {self.path} was written by another run") from error
