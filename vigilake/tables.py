"""Reading input tables and the few session facts that operators need."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` (a file or a folder of files) under ``sf_dir``."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster for cut lineage.

    ``spark.checkpoint.dir`` of the session wins; a folder of our own (under the warehouse
    directory, which is shared wherever tables are) is set only if there is none.
    """
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return sc._jsc.sc().getCheckpointDir().get()
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not conf:
        conf = os.path.join(spark.conf.get("spark.sql.warehouse.dir", "spark-warehouse"), "_checkpoints")
    sc.setCheckpointDir(conf)
    return conf


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder: survives lost executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def width(spark: SparkSession) -> int:
    """Number of shuffle partitions the session asks for."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def small(df: DataFrame, limit_bytes: int = 8 << 20) -> bool:
    """Whether the optimizer's own estimate of ``df`` is below ``limit_bytes`` (a check before a broadcast)."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= limit_bytes
