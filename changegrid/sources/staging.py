"""Stage tables: results written once to the cluster's shared folder and read back.

A stage table cuts lineage the way ``DataFrame.checkpoint`` does, but as columnar, compressed
Parquet.  It lives under ``spark.checkpoint.dir``, which all executors share, so it survives the loss
of an executor.  Where that setting is missing and one machine does all (unit tests), a temporary folder is set.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where it is unset, a fresh temporary one in local mode only.

    On a cluster a temporary folder of the driver would be out of the executors' reach, so that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="changegrid-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as Parquet under the shared folder and returns a DataFrame that reads it.

    The schema is carried over, so an empty result keeps its columns.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stages/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
