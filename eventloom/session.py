"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
ROWS_PER_PARTITION = 15_000
"""Event rows for each partition of a shuffle: a row can become a dozen grid points, and windows sort a partition several times in one task."""
PARTITION_BYTES = 8 << 20


def local_session(cpus: str = "8", app: str = "eventloom", memory: str = "16g", folder: str | None = None) -> SparkSession:
    """Session for tests and benchmarks on one machine; ``folder`` (a new one if None) takes the intermediate tables."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config(CHECKPOINT_CONF, folder or tempfile.mkdtemp(prefix="eventloom-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can read and write: the one that ``spark.checkpoint.dir`` names.

    Only a session on one machine may go without the setting; it then gets a folder for the life of its
    application. On a cluster a missing setting is an error, because a machine-local folder is invisible to other executors.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    return _own_folder(spark.sparkContext.applicationId)


@lru_cache(maxsize=None)
def _own_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"{application}-")


def fit_shuffles(spark: SparkSession, rows: int) -> None:
    """Shuffles of this session get a partition for each ``ROWS_PER_PARTITION`` input rows at least, none is merged beyond ``PARTITION_BYTES``, and no task reads more of a file.

    A partition of a window or an aggregate is one task and cannot be split, so with a fixed number of them the memory of a task grows with the input.
    The same holds for the map-side aggregates of a task that reads a file: its part grows with the file up to 128 MB by default, where columns are packed tightly.
    Many partitions set before do not help alone, since they are merged up to 64 MB by default.
    Settings are only moved towards more and smaller partitions; adaptive execution merges what is too small.
    """
    partitions = "spark.sql.shuffle.partitions"
    wanted = -(-rows // ROWS_PER_PARTITION)
    if wanted > int(spark.conf.get(partitions)):
        spark.conf.set(partitions, wanted)
    if wanted <= spark.sparkContext.defaultParallelism:
        return
    for size in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"):
        given = spark.conf.get(size)
        unit = re.fullmatch(r"(\d+)\s*([kmgt]?)b?", given.strip().lower())
        if unit is None or int(unit[1]) << 10 * " kmgt".index(unit[2] or " ") > PARTITION_BYTES:
            spark.conf.set(size, PARTITION_BYTES)


def aggregate_in_order(spark: SparkSession) -> None:
    """Aggregates of this session whose rows arrive in the order of their keys hold one key at a time; otherwise all rows of a task are sorted and spilled again.

    Joins leave both sides dealt as they are when that is by some of the join's keys, since the rows of an aggregate after them must not be dealt anew.
    """
    spark.conf.set("spark.sql.execution.replaceHashWithSortAgg", True)
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", False)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a result once and go on from the stored table.

    For results that several branches of a plan read: without it each branch would compute them
    again. A stored table also survives the loss of executors.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
