"""Session settings and the shared folder for staged tables."""

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


# Incident times carry no zone, so they are read and shown in UTC.
SETTINGS = {"spark.sql.session.timeZone": "UTC"}


def apply_settings(spark: SparkSession) -> SparkSession:
    """The settings that results rely on, for a session built elsewhere."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution; executor sizes and shuffle partitions belong to ``spark-submit``."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can read, from ``spark.checkpoint.dir``.

    Only a local session, where driver and executors share one disk, may go without the setting.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_folder(spark.sparkContext.applicationId)


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"beatline-{application}-")


def staging_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; never reused, so reruns cannot mix their files."""
    return f"{shared_folder(spark)}/beatline/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back.

    Later reads neither compute them again nor see other rows, and a lost executor costs nothing but a read.
    """
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete staged tables that nothing reads any more."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


class Staging:
    """Staged tables of one job by name, so that each can go when it is used up."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: dict[str, str] = {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """The rows written and read back; a name used before is freed for the new table."""
        old = self.paths.pop(name, None)
        path = self.paths[name] = staging_path(self.spark, name)
        df.write.parquet(path)
        if old:
            discard(self.spark, old)
        return self.spark.read.parquet(path)

    def drop(self, *names: str) -> None:
        discard(self.spark, *(self.paths.pop(name) for name in names if name in self.paths))
