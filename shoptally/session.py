"""Session set-up and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

ROWS_PER_TASK = 250_000

def build_session(app="shoptally", master=None, shuffle_partitions=None, **conf) -> SparkSession:
    """Session with UTC times and adaptive execution, including skewed-join splitting."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, taken from ``spark.checkpoint.dir``.

    Where that is unset, as in tests, the warehouse of the session takes its place. On a cluster a warehouse on the driver's own
    disk is refused, as executors could not read it.
    """
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
        if folder.startswith(("/", "file:")) and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/shoptally/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; never reused, so a lost job leaves nothing half-written behind."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application; results that still read them must be written before."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Rows dealt evenly over the task slots, for iterative work on data that adaptive execution has coalesced.

    Round-robin, so that copies of one row do not meet in one task. With the number of ``rows``, for work of many short jobs,
    there is a task for each slot, and more only beyond ``ROWS_PER_TASK`` rows in each.
    """
    spark = df.sparkSession
    slots = spark.sparkContext.defaultParallelism
    if rows is None:
        return df.repartition(max(slots, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return df.repartition(slots * max(1, -(-rows // (slots * ROWS_PER_TASK))))


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it from there.

    Cuts the lineage like a checkpoint, survives the loss of any executor, and gives the optimizer the true size, which
    the estimates of iterated joins soon exceed beyond measure.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete a table that ``checkpointed`` has written and that nothing reads any more; any other is left alone."""
    spark = table.sparkSession
    root, files = _scratch_root(spark), table.inputFiles()
    folders = {name.rpartition("/")[0] for name in files}
    if len(folders) == 1 and f"{root}/table-" in (folder := folders.pop()):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
