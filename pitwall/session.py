"""Session settings and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_RUNTIME_CONF = {
    # every timestamp in the lake is UTC
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even when the parent then needs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # streams with state and timers need it; state beyond the heap stays on disk
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

_own_scratch: dict[str, str] = {}
# The tables written in the innermost open scope of this thread or task.
_scope: ContextVar[list[str] | None] = ContextVar("scratch_scope", default=None)


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the models rely on."""
    for key, value in _RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-JVM session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("pitwall")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Without one a temporary folder is made, in local mode only: on a cluster a
    machine-local folder would be lost together with its executor.
    """
    sc = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if shared:
        return shared.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.applicationId not in _own_scratch:
        _own_scratch[sc.applicationId] = tempfile.mkdtemp(prefix="pitwall-")
    return _own_scratch[sc.applicationId]


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder and read it back.

    Used where a relation has several consumers. Unlike a cache it survives the
    loss of executors, cuts the lineage, and keeps column pruning.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/pitwall/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    written = _scope.get()
    if written is not None:
        written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def materialise_observed(df: DataFrame, name: str, metrics: dict[str, Column]) -> tuple[DataFrame, dict]:
    """The same, with aggregates that the write observes on its way."""
    seen = Observation()
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in metrics.items()])
    return materialise(observed, name), seen.get


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that this thread materialises inside the block."""
    written: list[str] = []
    token = _scope.set(written)
    try:
        yield
    finally:
        _scope.reset(token)
        hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for path in written:
            target = hadoop_path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
