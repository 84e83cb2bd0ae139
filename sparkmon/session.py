"""Session factory and the shared scratch folder."""

import atexit
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_STAGED: list[str] = []
#: Folders of the open ``scratch`` blocks of this thread, the innermost one last.
_BLOCKS: ContextVar[tuple[list[str], ...]] = ContextVar("blocks", default=())

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def get_session(
    app: str = "sparkmon",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Session pinned to UTC.

    Under spark-submit the cluster's master and shuffle width stay as submitted; a plain Python
    start is local and gets 8 shuffle partitions unless told otherwise.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # HotSpot leaves methods above 8000 bytes interpreted; wide sensor projections exceed that
        # when fused into one method and run several times faster as separate ones.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    )
    master = master or os.environ.get("SPARK_MASTER")
    if master is None and "PYSPARK_GATEWAY_PORT" not in os.environ:
        master = "local[*]"
    if master is not None:
        builder = builder.master(master)
        if master.startswith("local"):
            # Block transfers inside one container need a resolvable driver address.
            builder = builder.config("spark.driver.host", "127.0.0.1").config(
                "spark.driver.bindAddress", "127.0.0.1"
            )
            shuffle_partitions = shuffle_partitions or 8
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="sparkmon-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def fresh_dir(spark: SparkSession, label: str, outlives: bool = False) -> str:
    """A path below the shared folder that no earlier run has used.

    It goes at the end of the :func:`scratch` block it is made in, or of the one around that if it
    ``outlives`` the block, else when Python ends.
    """
    path = f"{shared_dir(spark)}/sparkmon/{label}-{uuid.uuid4().hex}"
    owners = (_STAGED, *_BLOCKS.get())
    owners[max(0, len(owners) - 1 - outlives)].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Owns the folders made in the block, which go at its end; results are staged to outlive it."""
    held: list[str] = []
    mark = _BLOCKS.set((*_BLOCKS.get(), held))
    try:
        yield
    finally:
        _BLOCKS.reset(mark)
        _remove(spark, held)


def _remove(spark: SparkSession, paths: list[str]) -> None:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    while paths:
        path = jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(conf).delete(path, True)


def remove_staged(spark: SparkSession) -> None:
    """Remove all folders of :func:`fresh_dir`; what was read from them must have been used."""
    _remove(spark, _STAGED)


@atexit.register
def _remove_at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if _STAGED and spark is not None and spark.sparkContext._jsc is not None:
        remove_staged(spark)


def stage(df: DataFrame, label: str, outlives: bool = False) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    The folder goes as :func:`fresh_dir` says, or with :func:`remove_staged`.

    The written files cut the lineage, survive the loss of executors and have a known size, from
    which :func:`broadcast_if_small` and Catalyst choose between a broadcast and a shuffled join
    with skew splitting.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, label, outlives)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _planned_size(df: DataFrame) -> int:
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def is_small(staged: DataFrame) -> bool:
    """Whether the files of a staged table are within the session's broadcast limit."""
    limit = staged.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return _planned_size(staged) <= limit


def broadcast_if_small(staged: DataFrame) -> DataFrame:
    """Hint a broadcast of a small staged table and leave a large one to a shuffled join.

    Catalyst does not foresee how ``explode`` multiplies rows and may pick the wrong side of a
    join with exploded text.
    """
    return F.broadcast(staged) if is_small(staged) else staged
