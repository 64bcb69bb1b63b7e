"""Tables kept between the steps of a job, in the folder that all executors share.

A step that is read more than once, or whose lineage would grow without bound, is written as
Parquet below ``spark.checkpoint.dir``. The files survive the loss of any executor, unlike cached
blocks or local checkpoints. The folder of a session is removed when its driver's JVM ends: the file system itself
is told to do so, as Python has no JVM left to ask by then.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_roots: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session: ``spark.checkpoint.dir`` if set, else one under /tmp."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master.startswith(("local[", "local")) and not spark.sparkContext.master.startswith("local-cluster"):
            root = "file:///tmp/glossaria-shared"
        else:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _roots:
        _roots[app] = f"{root.rstrip('/')}/glossaria-{app}"
        fs, folder = hadoop_path(spark, _roots[app])
        fs.mkdirs(folder)
        fs.deleteOnExit(folder)
    return _roots[app]


def hadoop_path(spark: SparkSession, path: str):  # noqa: ANN201
    """The file system of a path and the path as that file system's object."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and return a reader of what was written."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
