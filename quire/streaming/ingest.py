"""New rows as they arrive: stateless conversion, and a versioned snapshot that batches are merged into.

A snapshot is a folder of versions.  A version is a table in ``bucket`` folders
and a manifest, a small file that names the version's live data folders, one for
each bucket.  A batch rewrites the buckets that it has rows of, and leaves the
others' folders as they are; then its manifest appears by one rename, so a
reader sees whole batches only.  A bucket is one folder after any number of
batches: reading costs what the rows cost, however many batches wrote them.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quire.operators.html import markdown_pages

#: Folders that a snapshot's rows are dealt into, by their key.
BUCKETS = 16


def markdown_stream(spark: SparkSession, path: str, schema: str = "page_id long, url string, html string") -> DataFrame:
    return markdown_pages(spark.readStream.schema(schema).parquet(path)).select("page_id", "url", "markdown")


class Snapshot:
    """The versions under ``target``, by the Hadoop file system of its path; one writer at a time.

    A batch rewrites the buckets of its rows: with many ``buckets`` (of a new snapshot; later ones keep them) it
    rewrites less, and a version has more folders.
    """

    def __init__(self, spark: SparkSession, target: str, buckets: int = BUCKETS):
        self.spark, self.target, self.buckets = spark, target, buckets
        jvm = spark.sparkContext._jvm
        self.path = jvm.org.apache.hadoop.fs.Path
        self.files = self.path(target).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        folder = self.path(f"{self.target}/_manifests")
        if not self.files.exists(folder):
            return []
        names = [s.getPath().getName() for s in self.files.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_")))

    def manifest(self, version: int | None = None) -> dict:
        """``batch``, ``schema`` and ``folders`` (bucket to path below the target) of a version, the newest if none is given."""
        found = self.versions()
        if version is None and not found:
            return {"version": -1, "batch": -1, "schema": None, "buckets": None, "folders": {}}
        stream = self.files.open(self.path(f"{self.target}/_manifests/{found[-1] if version is None else version}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def commit(self, manifest: dict) -> None:
        """The manifest appears under its name at once, or not at all."""
        folder = self.path(f"{self.target}/_manifests")
        self.files.mkdirs(folder)
        name = f"{manifest['version']}.json"
        part = self.path(folder, f"_{name}.part")
        out = self.files.create(part, True)
        try:
            out.write(bytearray(json.dumps(manifest).encode()))
        finally:
            out.close()
        if not self.files.rename(part, self.path(folder, name)):
            raise RuntimeError(f"version {manifest['version']} of {self.target} was written by someone else")

    def read(self, version: int | None = None) -> DataFrame:
        held = self.manifest(version)
        return self._rows(held, list(held["folders"]))

    def _rows(self, held: dict, buckets: list[str]) -> DataFrame:
        folders = [f"{self.target}/{held['folders'][b]}" for b in buckets if b in held["folders"]]
        if held["schema"] is None:
            raise FileNotFoundError(f"no version under {self.target}")
        return self.spark.read.schema(held["schema"]).parquet(*folders) if folders else self.spark.createDataFrame([], held["schema"])

    def merge(self, rows: DataFrame, key: str, batch: int) -> int:
        """A version with ``rows`` in place of those of the same keys; a batch that is merged already changes nothing.

        Of a batch's rows with one key the largest stays, whatever order they come in, so a rerun writes the same.
        """
        held = self.manifest()
        if batch <= held["batch"]:
            return held["version"]
        buckets = held["buckets"] or self.buckets
        names = [c for c in rows.columns if c != key]
        new = rows.groupBy(key).agg(F.max(F.struct(*names)).alias("x")).select(key, "x.*").withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
        version = held["version"] + 1
        where = f"version-{version}-batch-{batch}"
        touched = sorted(r._bucket for r in new.select("_bucket").distinct().collect())  # at most so many as there are buckets
        if touched:
            merged = new
            if held["folders"]:
                old = self._rows(held, [str(b) for b in touched]).join(new.select(key), key, "left_anti")
                merged = new.unionByName(old.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")), allowMissingColumns=True)
            merged.repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.target}/{where}")
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(key, *names).schema)
        folders = held["folders"] | {str(b): f"{where}/_bucket={b}" for b in touched}
        self.commit({"version": version, "batch": batch, "schema": schema, "buckets": buckets, "folders": folders})
        return version

    def clean(self, keep: int = 2) -> int:
        """Removes manifests but the last ``keep``, then data folders that none of those names; how many folders went."""
        found = self.versions()
        live = {f for v in found[-keep:] for f in self.manifest(v)["folders"].values()}
        for v in found[:-keep]:
            self.files.delete(self.path(f"{self.target}/_manifests/{v}.json"), False)
        gone = 0
        for s in self.files.listStatus(self.path(self.target)):
            name = s.getPath().getName()
            if not name.startswith("version-"):
                continue
            for b in self.files.listStatus(s.getPath()):
                if b.isDirectory() and f"{name}/{b.getPath().getName()}" not in live:
                    self.files.delete(b.getPath(), True)
                    gone += 1
            if not any(x.isDirectory() for x in self.files.listStatus(s.getPath())):
                self.files.delete(s.getPath(), True)
        return gone


def upsert_to(stream: DataFrame, target: str, checkpoint: str, key: str = "page_id") -> StreamingQuery:
    """Merges each batch into the snapshot under ``target``; ``latest`` reads the newest version."""

    def write(batch: DataFrame, number: int) -> None:
        Snapshot(batch.sparkSession, target).merge(batch, key, number)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(spark: SparkSession, target: str, key: str = "page_id") -> DataFrame:
    """The rows of the newest version, one for each key."""
    return Snapshot(spark, target).read()
