"""Tables that are changed in place: rows dealt to buckets by a hash of their key, and a manifest for each version.

A change reads and writes only the buckets that its keys fall into. A version is a small file that lists the folder of
every bucket; it is created only if it does not exist yet, so of two writers that start from one version the second
fails, and a reader sees a version as a whole, never parts of two. Old versions stay readable until they are vacuumed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docfields.session import materialise


class Conflict(RuntimeError):
    """Another writer has made this version."""


@dataclass(frozen=True)
class Version:
    number: int
    key: str
    buckets: int
    schema: str  # JSON
    folders: dict[int, str]  # of each bucket that has rows


class KeyedTable:
    """A table at ``path`` whose rows are known by one column."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # Files, through whatever file system the cluster has for the path.

    def _at(self, name: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _names(self, name: str) -> list[str]:
        store, where = self._at(name)
        return [f.getPath().getName() for f in store.listStatus(where)] if store.exists(where) else []

    def _manifest(self, number: int) -> str:
        return f"versions/{number:012d}.json"

    def _commit(self, version: Version) -> Version:
        """Write under a name of its own, then take the version's name, which fails if it is taken."""
        store, draft = self._at(f"versions/.{uuid.uuid4().hex}")
        out = store.create(draft, False)
        out.write(json.dumps(version.__dict__).encode())
        out.close()
        _, name = self._at(self._manifest(version.number))
        if store.exists(name) or not store.rename(draft, name):
            store.delete(draft, False)
            raise Conflict(f"version {version.number} of {self.path} is there already")
        return version

    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self._names("versions") if n.endswith(".json") and not n.startswith("."))

    def version(self, number: int | None = None) -> Version:
        """A version, the newest by default."""
        if number is None:
            found = self.versions()
            if not found:
                raise FileNotFoundError(f"no table at {self.path}")
            number = found[-1]
        store, where = self._at(self._manifest(number))
        source = store.open(where)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        finally:
            source.close()
        told = json.loads(text)
        return Version(**told | {"folders": {int(k): v for k, v in told["folders"].items()}})

    # Rows

    @staticmethod
    def _bucket(key: Column, buckets: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")

    def _write(self, rows: DataFrame, key: str, buckets: int) -> dict[int, str]:
        """``rows`` as one folder for each bucket; which there are."""
        folder = f"data/{uuid.uuid4().hex}"
        dealt = rows.withColumn("_bucket", self._bucket(F.col(key), buckets))
        dealt.repartition("_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/{folder}")
        return {int(n.split("=")[1]): f"{folder}/{n}" for n in self._names(folder) if n.startswith("_bucket=")}

    def create(self, rows: DataFrame, key: str, buckets: int) -> Version:
        """The first version; ``rows`` has one row for each key. Buckets should hold some 100 MB when the table is full."""
        return self._commit(Version(0, key, buckets, rows.schema.json(), self._write(rows, key, buckets)))

    def _read(self, version: Version, buckets: list[int]) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(version.schema))
        folders = [f"{self.path}/{version.folders[b]}" for b in buckets if b in version.folders]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def read(self, number: int | None = None) -> DataFrame:
        """All rows of a version."""
        version = self.version(number)
        return self._read(version, list(version.folders))

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The rows of ``keys`` (a frame with the key column); buckets without one are not opened."""
        version = self.version()
        return self._read(version, self._touched(keys, version)).join(keys.select(version.key).distinct(), version.key, "left_semi")

    def _touched(self, rows: DataFrame, version: Version) -> list[int]:
        found = rows.select(self._bucket(F.col(version.key), version.buckets).alias("b")).distinct()
        return sorted(r.b for r in found.collect())  # at most as many as buckets

    def change(self, changes: DataFrame, apply: Callable[[DataFrame, DataFrame], DataFrame]) -> Version:
        """A new version in which ``apply(rows, changes)`` has the rows of the buckets that ``changes`` have keys in.

        ``apply`` may change and add rows with keys of ``changes`` and must leave others as they are. Without changes
        the version stays.
        """
        version = self.version()
        changes = materialise(changes, "changes")
        touched = self._touched(changes, version)
        if not touched:
            return version
        schema = T.StructType.fromJson(json.loads(version.schema))
        rows = apply(self._read(version, touched), changes).select(*schema.names)
        made = self._write(rows, version.key, version.buckets)
        if strange := set(made) - set(touched):
            raise ValueError(f"rows of buckets {sorted(strange)[:5]} were made, in which no change has a key")
        kept = {b: f for b, f in version.folders.items() if b not in touched}
        return self._commit(Version(version.number + 1, version.key, version.buckets, version.schema, kept | made))

    def vacuum(self, keep: int = 2) -> int:
        """Delete all but the newest ``keep`` versions and the folders that only they have; how many versions went."""
        found = self.versions()
        old, new = found[:-keep], found[-keep:]
        used = {f for n in new for f in self.version(n).folders.values()}
        gone = {f for n in old for f in self.version(n).folders.values()} - used
        for name in [*gone, *(self._manifest(n) for n in old)]:
            store, where = self._at(name)
            store.delete(where, True)
        return len(old)
