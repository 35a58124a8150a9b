"""Session settings the operators count on, and the shared folder for written tables."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Keys of a dedupe within a long delay stay on local disk, not on the executor's heap.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(
    app_name: str = "tidewire", master: str | None = None, **conf: str
) -> SparkSession:
    """Session with UTC clocks and Arrow; sizes and executors are the cluster's to set."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@lru_cache(maxsize=None)
def _own_dir(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"tidewire-{application}-")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it.

    Only a local master may go without the setting; it then gets a fresh folder, the same
    one as long as the application runs.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
    return _own_dir(context.applicationId)


def fresh_path(spark: SparkSession, name: str) -> str:
    """An unused path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
