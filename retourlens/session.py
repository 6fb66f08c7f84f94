"""Session set-up and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def build_session(app: str = "retourlens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; pass Spark settings as keywords
    with ``__`` in place of dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: there driver and
    executors are one process.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or context.getConf().get(CHECKPOINT_SETTING)
    current = context.getCheckpointDir()
    if folder:
        if current is None:
            context.setCheckpointDir(folder)
        return folder.rstrip("/")
    if current is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_SETTING} must name a folder shared by the cluster")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="retourlens-"))
        current = context.getCheckpointDir()
    return current.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other call returns."""
    return f"{shared_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage so that a lost executor replays a file scan rather than
    the whole history, and gives the planner the true size of the table: small
    ones are then broadcast by Spark's own threshold, large ones are not.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settle_all(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Settle independent tables in concurrent jobs."""
    with ThreadPoolExecutor(max_workers=max(1, len(tables))) as pool:
        running = {name: pool.submit(settle, df, name) for name, df in tables.items()}
        return {name: job.result() for name, job in running.items()}
