"""Where intermediate tables are kept so that a lost executor costs a re-read, not a re-run."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Shuffle files go at the end of the query that wrote them, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that `spark.checkpoint.dir` names.

    A session without one gets a temporary folder if it runs in a single process (tests); on a cluster, where
    executors would write to disks of their own, that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='spark-shared-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write `df` as Parquet in the shared folder and read it back: lineage ends here, and shuffle files go."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def removed(*frames: DataFrame) -> None:
    """Delete the files behind frames that `saved` returned, once nothing reads them any more."""
    for df in frames:
        spark = df.sparkSession
        jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(hadoop).delete(path, True)


def spread(spark: SparkSession) -> int:
    """Partitions that a shuffle gets in this session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
