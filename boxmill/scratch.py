"""Written tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """A folder that driver and executors share: the one of spark.checkpoint.dir.

    Only where a local session has none (tests), a temporary folder is set; on a
    cluster a missing setting is an error, as its machines would not share the folder.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-"))
    return context.getCheckpointDir()


def materialise(df: DataFrame) -> DataFrame:
    """Write df as Parquet into the shared scratch folder and read it again.

    Cuts the lineage and survives lost executors. The folder is removed when the
    session's JVM ends.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)
