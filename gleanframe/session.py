"""Session settings the jobs rely on, and where lineage cuts are written."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app_name: str = "gleanframe", **conf: str) -> SparkSession:
    """A session with adaptive execution, skew-join splitting and UTC pinned.

    Master, memory and ``spark.checkpoint.dir`` are left to spark-submit.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # split a skewed join side even when a later step then needs a shuffle
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        # stateful streaming control keeps typed state
        STATE_STORE: ROCKSDB_STORE,
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def typed_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep typed state, also in a session that was not built here.

    Spark's default state store cannot; a stream takes a copy of the settings as it starts, so
    the session gets its own back. A store other than the default stays.
    """
    before = spark.conf.get(STATE_STORE)
    if not before.endswith(".HDFSBackedStateStoreProvider"):
        yield
        return
    spark.conf.set(STATE_STORE, ROCKSDB_STORE)
    try:
        yield
    finally:
        spark.conf.set(STATE_STORE, before)


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        context.setCheckpointDir(configured)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="gleanframe-ckpt-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path below the checkpoint folder that all executors share."""
    _ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet below the shared checkpoint folder and read back.

    Unlike a checkpoint it computes ``df`` once, and later reads fetch only the columns they need.
    """
    spark = df.sparkSession
    path = shared_folder(spark, "written")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read on from there."""
    _ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
