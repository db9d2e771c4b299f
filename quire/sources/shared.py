"""Tables and folders between steps, where the driver and all executors see them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def own_folder(spark: SparkSession, name: str) -> str:
    """A new path of this application in the folder that ``spark.checkpoint.dir`` names.

    Only a local session, whose executors are in the driver, gets a temporary one where none is set.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="quire-shared-")
        spark.sparkContext.setCheckpointDir(found)
    return f"{found}/quire-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read again: what is costly is not done twice, and survives lost executors."""
    path = own_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
