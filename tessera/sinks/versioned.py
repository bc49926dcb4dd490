"""Tables that are replaced atomically.

A table is a folder of immutable data folders (``data/<id>``) and numbered manifests
(``manifests/<n>.json``). A manifest names the folders that make up one version, the
schema, and the commit's own properties. A write goes to a new data folder first and is
published by creating the next manifest, which is the only step a reader can see:

* a write that fails midway leaves files that no manifest names; readers go on with the
  version before;
* a reader is pinned to the folders of its version, so a replacement under a running
  query changes nothing for it;
* two writers that start from the same version cannot both publish: a manifest is created
  without overwriting, and the second writer gets ``ConcurrentWrite``;
* ``overwrite_partitions`` replaces only the partitions that the new rows have; the others
  are named again, not copied;
* ``expire`` removes old manifests and the folders that only they name.

Manifests are read and written through Spark's (Hadoop's) file system, so the table may
lie wherever the session's files do.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ConcurrentWrite(RuntimeError):
    """Another writer published the version this one was about to publish."""


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}".rstrip("/"))

    # ------------------------------------------------------------ versions

    def versions(self) -> list[int]:
        folder = self._path("manifests")
        if not self._fs.exists(folder):
            return []
        return sorted(int(s.getPath().getName()[:-5]) for s in self._fs.listStatus(folder)
                      if s.getPath().getName().endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        """Manifest of a version (the latest if none is given); {} where there is none."""
        number = version if version is not None else max(self.versions(), default=None)
        if number is None:
            return {}
        stream = self._fs.open(self._path(f"manifests/{number:012d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _publish(self, number: int, folders: list[dict], schema: T.StructType, partitioned_by: list[str], properties: dict) -> int:
        body = {"version": number, "folders": folders, "schema": json.loads(schema.json()), "partitioned_by": partitioned_by,
                "properties": properties}
        draft = self._path(f"manifests/.{uuid.uuid4().hex}.draft")
        final = self._path(f"manifests/{number:012d}.json")
        stream = self._fs.create(draft, False)
        stream.write(bytearray(json.dumps(body).encode()))
        stream.close()
        # a rename onto an existing file fails, so that one of two writers is told
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            self._fs.delete(draft, False)
            raise ConcurrentWrite(f"version {number} of {self.path} exists already")
        return number

    # ------------------------------------------------------------ writing

    def _write(self, df: DataFrame, partitioned_by: list[str]) -> str:
        folder = f"data/{uuid.uuid4().hex}"
        writer = df.write
        if partitioned_by:
            writer = df.hint("rebalance", *partitioned_by).write.partitionBy(*partitioned_by)
        writer.parquet(f"{self.path}/{folder}")
        return folder

    def _partitions(self, folder: str, depth: int) -> list[str]:
        level = [folder]
        for _ in range(depth):
            level = [f"{f}/{s.getPath().getName()}" for f in level for s in self._fs.listStatus(self._path(f))
                     if s.isDirectory() and "=" in s.getPath().getName()]
        return level

    def replace(self, df: DataFrame, partitioned_by: list[str] | None = None, properties: dict | None = None,
                base: int | None = None) -> int:
        """Publish ``df`` as the whole table. ``base``: the version the rows were derived from."""
        number = (max(self.versions(), default=0) if base is None else base) + 1
        parts = partitioned_by or []
        folder = self._write(df, parts)
        folders = [{"path": p, "root": folder} for p in self._partitions(folder, len(parts))]
        return self._publish(number, folders, df.schema, parts, properties or {})

    def overwrite_partitions(self, df: DataFrame, partitioned_by: list[str], properties: dict | None = None,
                             base: int | None = None) -> int:
        """Publish a version in which the partitions that ``df`` has rows for are replaced."""
        current = self.manifest(base) if base else self.manifest()
        if not current:
            return self.replace(df, partitioned_by, properties, base)
        folder = self._write(df, partitioned_by)
        fresh = self._partitions(folder, len(partitioned_by))
        replaced = {p[len(folder):] for p in fresh}
        kept = [f for f in current["folders"] if f["path"][len(f["root"]):] not in replaced]
        return self._publish(current["version"] + 1, kept + [{"path": p, "root": folder} for p in fresh], df.schema, partitioned_by,
                             properties or {})

    # ------------------------------------------------------------ reading

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version (the latest if none is given), pinned to its files."""
        m = self.manifest(version)
        if not m:
            raise FileNotFoundError(f"no version of {self.path}")
        schema = T.StructType.fromJson(m["schema"])
        roots: dict[str, list[str]] = {}
        for f in m["folders"]:
            roots.setdefault(f["root"], []).append(f["path"])
        out = None
        for root, paths in sorted(roots.items()):
            part = (self.spark.read.schema(schema).option("basePath", f"{self.path}/{root}")
                    .parquet(*[f"{self.path}/{p}" for p in sorted(paths)]).select(*[F.col(f"`{f.name}`") for f in schema]))
            out = part if out is None else out.unionByName(part)
        return out if out is not None else self.spark.createDataFrame([], schema)

    # ------------------------------------------------------------ housekeeping

    def expire(self, keep: int = 2) -> list[int]:
        """Remove all but the last ``keep`` versions; data folders that no kept version
        names go as well, also those of writes that never got published and are older than
        the kept manifests. Returns the versions removed."""
        numbers = self.versions()
        gone, kept = numbers[:-keep], numbers[-keep:]
        used = {f["root"] for n in kept for f in self.manifest(n)["folders"]}
        oldest = min((self._fs.getFileStatus(self._path(f"manifests/{n:012d}.json")).getModificationTime() for n in kept), default=0)
        for n in gone:
            self._fs.delete(self._path(f"manifests/{n:012d}.json"), False)
        folder = self._path("data")
        for s in self._fs.listStatus(folder) if self._fs.exists(folder) else []:
            name = f"data/{s.getPath().getName()}"
            if name not in used and s.getModificationTime() <= oldest:
                self._fs.delete(s.getPath(), True)
        return gone
