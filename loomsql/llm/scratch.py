"""Tables written between steps, in the folder that all executors share, and names that clash with no column."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Spark's setting that deletes an execution's shuffle files at its end.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir as the session has it; only where it is unset, as in tests, a local folder that is then
    set for the session."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not found:
        found = f"file://{tempfile.mkdtemp(prefix='loomsql-')}"
        spark.sparkContext.setCheckpointDir(found)
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """The rows as a Parquet table in the shared folder: computed once, without lineage, and safe from lost executors. The
    shuffle files of the step are deleted when it has ended, not when the driver happens to collect its garbage."""
    spark = df.sparkSession
    path = f"{folder(spark)}/loomsql-{name}-{uuid.uuid4().hex}"
    schema = df.schema
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path, compression=compression)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(schema).parquet(path)
    out._written_to = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Delete tables that written() gave and that nothing reads any more; what is still read is left to the cluster's
    clean-up of the folder."""
    for df in tables:
        jvm = df.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(df._written_to)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def fresh(name: str, *frames: DataFrame) -> str:
    """The name, with underscores until no column of the frames has it in upper or lower case."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
