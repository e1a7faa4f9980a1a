"""Tables between the rounds of iterative operators."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Folders made where no shared one is named, by application.
_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only a local session, whose executors are the driver, may do without."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        name = spark.sparkContext.applicationId
        base = _LOCAL.get(name) or f"file://{tempfile.mkdtemp(prefix='tidemark-')}"
        _LOCAL[name] = base
    return base.rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, rows: int, each: int, *keys: str) -> DataFrame:
    """``df``, of about ``rows`` rows, dealt by key into partitions of about ``each`` rows: what one task holds stays the
    same as the table grows. All cores get some, also of a table that is one small file."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / each)), *keys)
