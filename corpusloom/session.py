"""Session settings shared by the library, the tests and the benchmark."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from threading import Lock
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

T, R = TypeVar("T"), TypeVar("R")

#: Independent jobs that run side by side; each may keep a copy of its rows cached.
BESIDE = 4

#: Settings that hold on a laptop and on a cluster alike.  Shuffle partitions
#: are only a starting point: AQE coalesces small ones and splits skewed ones.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(app: str = "corpusloom", cpus: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "12g") -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any.

    Only a local master, where no folder is named, gets a temporary one: on a
    cluster a machine-local folder would be lost with its machine.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and context.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="corpusloom-checkpoint-")
    if folder:
        context.setCheckpointDir(folder)
    return folder


def settle(df: DataFrame) -> DataFrame:
    """Computes ``df`` once and cuts its lineage.

    Written to the shared checkpoint folder, so it survives lost executors,
    keeps its partitioning and keeps later plans short; what was shuffled for it
    goes at once.  Where no such folder exists the frame is persisted instead.
    """
    if not checkpoint_dir(df.sparkSession):
        return df.persist()
    with _TIDYING:
        conf = df.sparkSession.conf
        if not _tidied:
            _before[:] = [conf.get(_CLEANUP, None)]
            conf.set(_CLEANUP, "true")
        _tidied.append(1)
    try:
        return df.select("*").checkpoint(eager=True)  # a plan of its own, made under this setting
    finally:
        with _TIDYING:
            _tidied.pop()
            if not _tidied:
                conf.set(_CLEANUP, _before[0]) if _before[0] is not None else conf.unset(_CLEANUP)


#: Whether Spark removes a query's shuffle files as it ends; set while frames are settled, by several threads perhaps.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_TIDYING, _tidied, _before = Lock(), [], [None]


def drop(df: DataFrame) -> None:
    """Deletes what :func:`settle` wrote of ``df``; nothing may read it any more.

    A frame that is persisted instead stays, as later ones may yet be computed from it.
    """
    plan = df._jdf.queryExecution().logical()
    kept = plan.rdd().getCheckpointFile() if plan.getClass().getSimpleName() == "LogicalRDD" else None
    if kept is None or kept.isEmpty():
        return
    spark = df.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(kept.get())
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partitions by unique keys into ``spark.sql.shuffle.partitions`` parts.

    The explicit number keeps AQE from merging parts by their bytes: text work
    costs far more time per byte than AQE assumes.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys)


def widen(df: DataFrame) -> DataFrame:
    """Evens out an input that arrives in fewer parts than there are cores.

    A small file is one part whatever its cost per row; large inputs already
    split into many and pass through unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def once(value: Column) -> Column:
    """``value``, closed to filters from above: a generator over one element.

    The optimizer pushes a filter on a column down by writing its expression out again,
    also below joins, where it would run on rows that the join drops.
    """
    return F.explode(F.array(value))


def beside(run: Callable[[T], R], items: Iterable[T]) -> list[R]:
    """``run`` of every item, in order, a few at once.

    For work made of many short jobs, such as iterative fits: what one of them waits for
    between its jobs the others use.
    """
    with ThreadPoolExecutor(BESIDE) as pool:
        return list(pool.map(run, items))
