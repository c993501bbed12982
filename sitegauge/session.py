"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = "local[*]", shuffle_partitions: int | None = 8,
                  app: str = "sitegauge", extra: dict | None = None) -> SparkSession:
    """Session with the settings every job here assumes.

    AQE re-plans joins and coalesces partitions at runtime; skew-join splitting
    is on; the UI server stays off; timestamps are read as UTC. ``master=None``
    leaves the master to ``spark-submit``; ``shuffle_partitions=None`` keeps
    the cluster's setting.
    """
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = (
        builder
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    sc = _context(spark)
    if sc is not None:
        sc.setLogLevel("ERROR")
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None on a Spark Connect session."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no context
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting one only when unset.

    On a cluster the folder must be shared storage named by
    ``spark.checkpoint.dir``; a machine-local temporary folder is only
    acceptable when the master is local (tests, laptop runs).
    """
    sc = _context(spark)
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc is None:
            return configured
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage "
            "(for example an object-store or HDFS folder) before running jobs")
    folder = tempfile.mkdtemp(prefix="sitegauge-ckpt-")
    if sc is None:
        return folder
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def freeze(df: DataFrame, name: str = "table") -> DataFrame:
    """Materialise ``df`` as a Parquet table in the checkpoint folder and read
    it back, which cuts its lineage.

    Used where a result feeds both a small driver-side decision and the main
    plan, or where a non-deterministic step (range sampling) must be seen
    identically by every consumer. The table sits on the shared storage named
    by ``spark.checkpoint.dir``, so it survives executor loss; unlike
    ``Dataset.checkpoint`` on an unpersisted plan it is computed once, and
    readers get column pruning and filter pushdown.
    """
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/sitegauge-{name}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def concurrently(*jobs: Callable):
    """Run independent driver-side actions at the same time and return their
    results in order. Spark schedules jobs from several driver threads side
    by side, so two materialisations that each leave executors idle (a
    narrow scan, a small aggregate) overlap instead of queueing.

    Threads are :class:`pyspark.InheritableThread`, so the caller's job
    group, description and scheduler pool carry over (cancelling the
    caller's job group cancels these jobs too). The first error is raised.
    """
    if len(jobs) == 1:
        return [jobs[0]()]
    import threading

    try:
        from pyspark import InheritableThread
        from pyspark import SparkContext
        thread_class = InheritableThread if SparkContext._active_spark_context else threading.Thread
    except ImportError:
        thread_class = threading.Thread

    results: list = [None] * len(jobs)
    errors: list = [None] * len(jobs)

    def run(i: int, job: Callable) -> None:
        try:
            results[i] = job()
        except BaseException as e:  # noqa: BLE001 - re-raised below
            errors[i] = e

    threads = [thread_class(target=run, args=(i, job)) for i, job in enumerate(jobs)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    for e in errors:
        if e is not None:
            raise e
    return results


def freeze_many(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """:func:`freeze` several independent DataFrames concurrently."""
    names = list(frames)
    done = concurrently(*[(lambda n=n: freeze(frames[n], n)) for n in names])
    return dict(zip(names, done))
