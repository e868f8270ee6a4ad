"""Session settings and staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ARROW_BYTES = 8 << 20
_local_stage: dict[str, str] = {}


def get_spark(app: str = "citelake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    Partition counts are left to the cluster's own configuration unless given.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Articles dealt by their number bucket meet their hits there, without a shuffle of their own.
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it.

    A local session without the setting gets a temporary folder. A cluster
    session must name one: a machine's own folder would not survive there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_stage:
        _local_stage[app] = tempfile.mkdtemp(prefix="citelake-")
    return _local_stage[app]


def stage_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/citelake/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, group_bytes: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage, so a lost executor costs a re-read of a table and later
    steps see one fixed set of rows, with column pruning on every re-read.
    A row group is one task's work when it is read: with smaller ones, ``group_bytes``, few
    tasks that write do not leave few that read.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    writer = df.write if group_bytes is None else df.write.option("parquet.block.size", group_bytes)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """From here on, the session's Arrow batches end at ``ARROW_BYTES``, unless they end before. A task holds
    several, in the JVM and in each Python worker.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark.conf.get(key).lower()
    if not (held.removesuffix("b").isdigit() and int(held.removesuffix("b")) <= ARROW_BYTES):
        spark.conf.set(key, str(ARROW_BYTES))


def spread(scan: DataFrame) -> DataFrame:
    """Redistribute a scan that comes in fewer partitions than there are cores.

    For costly work per row on few files. Large inputs come in many splits and
    pass unchanged. Give it plain scans only: counting the partitions of a plan
    with shuffles would run them.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
