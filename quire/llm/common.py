"""What the corpus operators share: table access, written stages, Arrow helpers."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, named by ``spark.checkpoint.dir``.

    Only a local session, whose executors are in the driver, gets a temporary one where none is set.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="quire-shared-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def stage_dir(spark: SparkSession) -> str:
    """This application's own part of the shared folder."""
    return f"{shared_dir(spark)}/quire-{spark.sparkContext.applicationId}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts lineage and survives lost executors."""
    path = f"{stage_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: A key is hot from this share of all rows on, so no more than so many keys are.
HOT_SHARE = 1024


def joined_by_key(rows: DataFrame, of_keys: DataFrame, key: str, members: str, total: int) -> DataFrame:
    """``rows`` with the columns of ``of_keys``: a row for each key, with how many of ``total`` rows have it in ``members``.

    Hot keys, at most HOT_SHARE, are broadcast, so their rows stay where they are; the others' are shuffled, at any size.
    ``of_keys`` is read several times: give a staged one.
    """
    is_hot = F.col(members) * HOT_SHARE >= total
    hot, others = of_keys.filter(is_hot).drop(members), of_keys.filter(~is_hot).drop(members)
    return rows.join(F.broadcast(hot), key).unionByName(rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(others.hint("merge"), key))


_HELD: dict[str, Any] = {}


def give_back() -> None:
    """Returns freed memory to the system where the C library can; an idle worker keeps it otherwise."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def held_by_worker(name: str, make: Callable[[], Any]) -> Any:
    """What one operator keeps between the tasks of a worker process.  Another operator's is let go, so they don't add up."""
    if name not in _HELD:
        _HELD.clear()
        give_back()
        _HELD[name] = make()
    return _HELD[name]


def map_slices(df: DataFrame, make: Callable[[], Callable[..., list[tuple]]], schema: str, slice_bytes: int = 4 << 20) -> DataFrame:
    """``make()`` builds, once for each task, the function from lists of a slice's columns to output rows.

    Batches are sliced by bytes, so that a run of very long texts does not pile up in a worker.
    """
    out_type = StructType.fromDDL(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        several = make()
        arrow = to_arrow_schema(out_type)
        for batch in batches:
            step = max(1, int(batch.num_rows * slice_bytes / max(batch.nbytes, 1)))
            for at in range(0, batch.num_rows, step):
                rows = several(*(c.to_pylist() for c in batch.slice(at, step).columns))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)

    return df.mapInArrow(run, out_type)


def map_rows(df: DataFrame, make: Callable[[], Callable[..., tuple]], schema: str) -> DataFrame:
    """One output row for each input row."""

    def make_slices():
        one = make()
        return lambda *columns: [one(*row) for row in zip(*columns, strict=True)]

    return map_slices(df, make_slices, schema)


def aside(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` as doc_id (long), text and its other columns under plain numbers, and what undoes that.

    Whatever the other columns are called, they do not clash with names that operators use.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    inner = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *[F.col(f"`{c}`").alias(f"_{k}") for k, c in enumerate(others)])

    def back(df: DataFrame) -> DataFrame:
        of = {"doc_id": F.col("doc_id").cast(docs.schema["doc_id"].dataType), "text": F.col("text")} | {c: F.col(f"_{k}") for k, c in enumerate(others)}
        if "n_chars" in others:
            of["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
        return df.select(*[of[c].alias(c) for c in docs.columns])

    return inner, back


def doc_id_crc_mod(n: int):
    """crc32 of doc_id as text, modulo ``n``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def crc_mod(doc_id: int | None, n: int) -> int | None:
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % n


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def clear_stages(spark: SparkSession) -> None:
    """Removes this application's stage tables from the shared folder, once no DataFrame made from them is needed."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(stage_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
