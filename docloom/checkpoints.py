"""Tables written to the folder that all executors share, to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _own_dir() -> str:
    return f"file://{tempfile.mkdtemp(prefix='spark-docloom-')}"


def shared_dir(spark: SparkSession) -> str:
    """This application's folder in that of spark.checkpoint.dir; in a temporary one where that is unset in local mode. On a
    cluster it must be set."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at and not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{(at or _own_dir()).rstrip('/')}/docloom-{spark.sparkContext.applicationId}"


def release(spark: SparkSession) -> None:
    """Remove all tables that this application has written there. For the end of a job, once its results are written:
    DataFrames that come from such tables can't be read afterwards."""
    at = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


#: How tables are packed: they lie there until the application ends, whole texts among them. Two thirds of Spark's default for
#: texts, four fifths for token ids.
_PACKED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "2"}


def materialise(df: DataFrame, name: str = "table") -> DataFrame:
    """Write `df` as Parquet into the shared folder and read it back.

    What was computed survives the loss of any executor, and plans built on the result start at a file scan
    whose size Spark knows.
    """
    at = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**_PACKED).parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)
