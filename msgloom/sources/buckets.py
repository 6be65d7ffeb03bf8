"""Tables that grow batch by batch, in hash buckets that a manifest names.

Data lies in folders that are never changed once written. Which of them count is said by the newest manifest, a small file that
appears whole (it is written under another name and renamed). A commit writes its folders first and its manifest last,
so one that is cut off leaves the table as it was, and its folders are not read. A batch that the manifest lists has been
committed; committing it again does nothing.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def bucket_of(*key: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


class BucketTable:
    """A table below ``path``, a folder that driver and executors share. ``buckets`` is fixed by the first commit."""

    def __init__(self, spark: SparkSession, path: str, buckets: int):
        self.spark, self.path = spark, path.rstrip("/")
        self.buckets = self.manifest().get("buckets", buckets)

    def _files(self):
        jvm = self.spark.sparkContext._jvm
        make = jvm.org.apache.hadoop.fs.Path
        return make, make(self.path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def manifest(self) -> dict:
        """The newest one: version, buckets, batches (id to digest), folders (bucket to folder names), schema."""
        make, files = self._files()
        folder = make(f"{self.path}/manifests")
        names = [f.getPath().getName() for f in files.listStatus(folder)] if files.exists(folder) else []
        versions = sorted(n for n in names if n.endswith(".json"))
        if not versions:
            return {"version": 0, "batches": {}, "folders": {}}
        return json.loads(self.spark.read.text(f"{self.path}/manifests/{versions[-1]}", wholetext=True).first()[0])

    def read(self, of: list[int] | None = None, name: str = "data") -> DataFrame | None:
        """The rows of some buckets, of all by default; None if nothing was ever committed. Only their folders are listed."""
        manifest = self.manifest()
        if name not in manifest.get("schema", {}):
            return None
        wanted = manifest["folders"] if of is None else {str(b): manifest["folders"].get(str(b), []) for b in of}
        paths = [f"{self.path}/{name}/{folder}/bucket={b}" for b, folders in wanted.items() for folder in folders]
        reader = self.spark.read.schema(manifest["schema"][name])
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], manifest["schema"][name])

    def commit(self, batch: str, digest: str, tables: dict[str, DataFrame], replace: bool) -> bool:
        """Add a batch's ``tables`` (each with a column ``bucket``); with ``replace`` they take the place of what their buckets held.

        Tables of one commit have the same buckets. False if the batch is there already; a batch with another digest than the
        one committed under its name is an error.
        """
        manifest = self.manifest()
        if self.committed(batch, digest):
            return False
        folder = uuid.uuid4().hex
        schemas = {}
        for name, table in tables.items():
            schemas[name] = ", ".join(f"`{c}` {t}" for c, t in table.dtypes if c != "bucket")
            table.repartition("bucket").write.partitionBy("bucket").parquet(f"{self.path}/{name}/{folder}")
        touched = self._buckets_in(f"{self.path}/{next(iter(tables))}/{folder}") if tables else []
        folders = {**manifest["folders"], **{b: ([] if replace else manifest["folders"].get(b, [])) + [folder] for b in touched}}
        self._publish(
            {
                "version": manifest["version"] + 1,
                "buckets": self.buckets,
                "batches": {**manifest["batches"], batch: digest},
                "folders": folders,
                "schema": {**manifest.get("schema", {}), **schemas},
            }
        )
        return True

    def committed(self, batch: str, digest: str) -> bool:
        known = self.manifest()["batches"].get(batch)
        if known not in (None, digest):
            raise ValueError(f"batch {batch!r} was committed with other rows")
        return known is not None

    def _buckets_in(self, folder: str) -> list[str]:
        make, files = self._files()
        names = [f.getPath().getName() for f in files.listStatus(make(folder))]
        return sorted(n.removeprefix("bucket=") for n in names if n.startswith("bucket="))

    def _publish(self, manifest: dict) -> None:
        make, files = self._files()
        target = make(f"{self.path}/manifests/{manifest['version']:012d}.json")
        draft = make(f"{self.path}/manifests/{uuid.uuid4().hex}.draft")
        out = files.create(draft, True)
        out.write(json.dumps(manifest).encode())
        out.close()
        if files.exists(target) or not files.rename(draft, target):
            files.delete(draft, False)
            raise RuntimeError("another commit came first; commit the batch again")

    def vacuum(self) -> int:
        """Delete the folders and manifests that the newest manifest does not need; how many folders went. No commit may be under way."""
        make, files = self._files()
        manifest = self.manifest()
        used = {(b, f) for b, folders in manifest["folders"].items() for f in folders}
        gone = 0
        for name in manifest.get("schema", {}):
            for commit in files.listStatus(make(f"{self.path}/{name}")):
                own = commit.getPath().getName()
                for b in self._buckets_in(f"{self.path}/{name}/{own}"):
                    if (b, own) not in used:
                        gone += bool(files.delete(make(f"{self.path}/{name}/{own}/bucket={b}"), True))
        for f in files.listStatus(make(f"{self.path}/manifests")):
            if f.getPath().getName() != f"{manifest['version']:012d}.json":
                files.delete(f.getPath(), False)
        return gone


def digest_of(rows: DataFrame) -> str:
    """Number of rows and two hashes of them, in any order."""
    found = rows.agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64(F.struct(*rows.columns))).alias("x"), F.sum(F.xxhash64(F.lit(1), F.struct(*rows.columns)).cast("decimal(38,0)")).alias("s")
    ).first()
    return f"{found['n']}:{found['x'] or 0}:{found['s'] or 0}"
