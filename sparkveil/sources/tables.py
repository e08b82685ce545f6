"""Intermediate tables in the folder that the cluster shares."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Compression of facts, whose rows hold hashes and codes. Mappings keep the default one: Spark broadcasts by the bytes of a
# file, and tighter ones would send tables of many times that size.
STORED = "zstd"
_own: list[str] = []
_written: list[tuple[str, str]] = []  # (application, path) of the tables of this process


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where that is unset a temporary one serves local mode, as in tests; executors
    on other machines could not read it, so that a cluster without the setting is refused."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: a cluster needs a folder that all its machines share")
        if not _own:
            _own.append(tempfile.mkdtemp(prefix="spark-tables-"))
        folder = f"file://{_own[0]}"
    return folder.rstrip("/")


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nobody has used; release deletes what is written there."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _written.append((spark.sparkContext.applicationId, path))
    return path


def materialized(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder, read again. Mapping tables are used many times over; plans stay short and a
    lost executor loses nothing."""
    spark = df.sparkSession
    path = new_folder(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Deletes all that this application has written under new_folder; to be called once its results are written."""
    own = [x for x in _written if x[0] == spark.sparkContext.applicationId]
    for entry in own:
        delete(spark, entry[1])
        _written.remove(entry)
    return len(own)
