"""Session settings, and how the library cuts lineage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: What the library's plans expect; sizes of partitions are left to adaptive execution.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def builder(name: str = "wattlake"):
    b = SparkSession.builder.appName(name)
    for key, value in SETTINGS.items():
        b = b.config(key, value)
    return b


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.

    Where that is unset: on one machine (tests) a temporary folder, on a cluster an error.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[[^-]*\])?", context.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="spark-checkpoint-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stash(df: DataFrame) -> DataFrame:
    """Write *df* once to the shared folder and read it back.

    It cuts the lineage and keeps a result that several later steps read; the files are in
    the folder all executors share, so a lost executor costs only the tasks it was running.
    Unlike ``checkpoint()`` it computes the rows once, and later plans know their size.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stash-{uuid.uuid4().hex}"
    df.write.parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    kept._stashed_at = path
    return kept


def forget(*stashed: DataFrame | None) -> None:
    """Deletes the files of stashes that nothing reads any more (what is no stash is left alone)."""
    for df in stashed:
        path = getattr(df, "_stashed_at", None)
        if path:
            spark = df.sparkSession
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
