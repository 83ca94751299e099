"""A keyed table that takes upserts while it is read: parts rewritten aside, then published by one small manifest.

    root/data/<writer>/_part=<n>/...   rows of a part as one writer left them; never changed
    root/versions/<number>.json        which folder holds each part; the largest number is the table

A manifest appears whole and only if its number is free, so of two writers one must look again. What a lost job wrote is
in no manifest and is never read.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.incremental import merge_upsert
from .scratch import written
from .tables import _at

PART = "_part"
#: Most parts of a table: a manifest has an entry for each, and comes to the driver.
MOST_PARTS = 16_384


class Store:
    """A table under root with unique keys, dealt by their hash into a fixed number of parts.

    root's file system must rename without replacing (HDFS and its like) or be local.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: list[str], parts: int = 64):
        if not 0 < parts <= MOST_PARTS:
            raise ValueError(f"1 to {MOST_PARTS} parts")
        self.spark, self.root, self.schema, self.keys, self.parts = spark, root.rstrip("/"), schema, keys, parts

    def versions(self) -> list[int]:
        fs, at = _at(self.spark, f"{self.root}/versions")
        names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def _manifest(self, version: int | None = None) -> tuple[int, dict[str, str]]:
        """The version's number and the folder of each part that has rows; 0 and none before the first."""
        found = self.versions()
        version = version if version is not None else found[-1] if found else 0
        if version == 0:
            return 0, {}
        fs, at = _at(self.spark, f"{self.root}/versions/{version:012d}.json")
        stream = fs.open(at)
        try:
            text = self.spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)
        finally:
            stream.close()
        content = json.loads(bytes(text).decode())
        if (content["keys"], content["parts"]) != (self.keys, self.parts):
            raise ValueError(f"{self.root} has keys {content['keys']} in {content['parts']} parts")
        return version, content["folders"]

    def _rows(self, folders) -> DataFrame:
        paths = [f"{self.root}/{f}" for f in folders]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of a version, the last one by default; a later write doesn't disturb it."""
        return self._rows(self._manifest(version)[1].values())

    def _publish(self, version: int, folders: dict[str, str]) -> bool:
        """Whether the version's manifest is ours now; False if another writer has taken the number."""
        jvm = self.spark.sparkContext._jvm
        fs, final = _at(self.spark, f"{self.root}/versions/{version:012d}.json")
        _, aside = _at(self.spark, f"{self.root}/versions/_{uuid.uuid4().hex}")
        fs.mkdirs(final.getParent())
        out = fs.create(aside, False)
        out.write(bytearray(json.dumps({"keys": self.keys, "parts": self.parts, "folders": folders}).encode()))
        out.close()
        try:
            if fs.getUri().getScheme() != "file":
                return fs.rename(aside, final)
            local = [jvm.java.nio.file.Paths.get(fs.makeQualified(p).toUri()) for p in (final, aside)]
            jvm.java.nio.file.Files.createLink(*local)  # a local rename would replace
            return True
        except Exception as e:
            if "FileAlreadyExists" in str(e):
                return False
            raise
        finally:
            if fs.exists(aside):
                fs.delete(aside, False)

    def upsert(self, new: DataFrame, rules: dict[str, str], tries: int = 20) -> int:
        """Merge rows of unique keys into the table (rules as in merge_upsert) and return the new version.

        Only parts that new has keys of are read and rewritten. Where another writer was first, the manifest is written again over
        theirs if they left our parts alone, and else the rows are merged again.
        """
        part = F.pmod(F.xxhash64(*self.keys), F.lit(self.parts)).cast("int")
        fresh = written(new.select(*self.schema.names))
        touched = [str(r[0]) for r in fresh.select(part.alias(PART)).distinct().collect()]  # as many as parts at most
        base, folders = self._manifest()
        ours = self._merged(fresh, part, [folders[p] for p in touched if p in folders], touched, rules)
        for _ in range(tries):
            if self._publish(base + 1, folders | ours):
                return base + 1
            then, later = self._manifest()
            if any(later.get(p) != folders.get(p) for p in touched):
                ours = self._merged(fresh, part, [later[p] for p in touched if p in later], touched, rules)
            base, folders = then, later
        raise RuntimeError(f"other writers were first {tries} times")

    def _merged(self, fresh: DataFrame, part, olds: list[str], touched: list[str], rules: dict[str, str]) -> dict[str, str]:
        folder = f"data/{uuid.uuid4().hex}"
        rows = merge_upsert(self._rows(olds), fresh, self.keys, rules).select(*self.schema.names)
        rows.withColumn(PART, part).repartition(PART).write.partitionBy(PART).parquet(f"{self.root}/{folder}")
        return {p: f"{folder}/{PART}={p}" for p in touched}

    def vacuum(self, keep: int = 10, hours: float = 24.0) -> int:
        """Delete all but the last versions, and writers' folders that those don't name and that are older; the number of folders.

        hours must exceed the longest write, as a folder is unnamed until it is published.
        """
        found = self.versions()
        last = found[-keep:]
        named = {f.split("/")[1] for v in last for f in self._manifest(v)[1].values()}
        for v in found[:-keep]:
            fs, at = _at(self.spark, f"{self.root}/versions/{v:012d}.json")
            fs.delete(at, False)
        fs, at = _at(self.spark, f"{self.root}/data")
        old = [s for s in (fs.listStatus(at) if fs.exists(at) else []) if s.getPath().getName() not in named and s.getModificationTime() < (time.time() - hours * 3600) * 1000]
        for s in old:
            fs.delete(s.getPath(), True)
        return len(old)
