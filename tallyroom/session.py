"""Session set-up, shuffle sizing and the shared scratch folder."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

# Bytes one shuffle task should hold: far below executor memory per core, so a
# sort in the task does not spill. AQE merges tasks that turn out smaller.
SHUFFLE_TASK_BYTES = 128 << 20

# Most tasks on either side of a shuffle. Blocks are tasks times tasks: beyond this
# they get too small to fetch and too many to track, and larger tasks that spill
# are the better choice (100 TB: 2 GB per scan task, 4 GB per shuffle task).
MAX_TASKS = 50_000

_SPLIT = "spark.sql.files.maxPartitionBytes"
_START = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

_JOB_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    # Merge small shuffle tasks up to the advisory size instead of keeping as
    # many as there are cores: fewer, larger output files.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
}


def get_session(app_name: str, jars: str | None = None, packages: str | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    """The process-wide session; a running one is reused as it is configured.

    ``jars``/``packages`` put a database connector on the classpath. Values given
    to spark-submit win over the defaults here, and ``conf`` wins over both.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if jars:
        builder = builder.config("spark.jars", jars)
    if packages:
        builder = builder.config("spark.jars.packages", packages)
    for name, value in (conf or {}).items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    given = spark.sparkContext.getConf()
    for name, value in _JOB_DEFAULTS.items():
        if not given.contains(name):
            spark.conf.set(name, value)
    return spark


def input_bytes(spark: SparkSession, path: str) -> int:
    """Stored size of a file or folder, from a listing (no content is read)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .load(path).select("length"))
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def size_tasks(spark: SparkSession, stored_bytes: int, growth: float = 2.0) -> int:
    """Set the tasks of scans and shuffles from the size of the input; shuffle tasks.

    ``growth`` is the assumed factor from stored to shuffled bytes. Without this a
    100 TB shuffle would run in the default 200 tasks of 500 GB each: AQE merges
    tasks but never adds any, so the number to start with must be large enough.
    Settings given by the user are kept.
    """
    if not spark.sparkContext.getConf().contains(_SPLIT):
        spark.conf.set(_SPLIT, str(max(128 << 20, stored_bytes // MAX_TASKS)))
    given = spark.sparkContext.getConf().get(_START)
    if given is not None:
        return int(given)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(least, min(MAX_TASKS, math.ceil(stored_bytes * growth / SHUFFLE_TASK_BYTES)))
    spark.conf.set(_START, str(tasks))
    return tasks


@contextmanager
def sized_tasks(spark: SparkSession, stored_bytes: int, growth: float = 2.0) -> Iterator[int]:
    """``size_tasks`` for what runs inside; afterwards the session has its settings back."""
    before = {name: spark.conf.get(name, None) for name in (_SPLIT, _START)}
    try:
        yield size_tasks(spark, stored_bytes, growth)
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name that every executor can reach; what is written there goes when the
    driver's JVM ends.

    The cluster names its shared folder in ``spark.checkpoint.dir``. Only a local
    session, where driver and executors are one process, may fall back to /tmp.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tallyroom-")
    path = f"{base.rstrip('/')}/tallyroom/{label}-{uuid.uuid4().hex}"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    # Only a folder that exists can be marked.
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return f"{path}/data"


def run_together(spark: SparkSession, actions: Sequence[Callable[[], Any]]) -> list[Any]:
    """Run independent Spark actions at the same time; their results in order.

    Executors that finish the last tasks of one job start on the next one instead
    of waiting for its slowest task.
    """
    with ThreadPoolExecutor(max(1, len(actions))) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(a)) for a in actions]
    return [s.result() for s in started]


def run_job(main: Callable[[], None]) -> None:
    """Run a job as a program: its session is stopped at the end, also on an error."""
    try:
        main()
    finally:
        active = SparkSession.getActiveSession()
        if active is not None:
            active.stop()
