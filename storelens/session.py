"""Spark session settings and the shared working folder."""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession

_LOCAL_ROOTS: dict[str, str] = {}
# What deletes the staged folders of each application.
_STAGED: dict[str, Callable[[], object]] = {}
_PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

# Settings that results, the handling of busy keys or the memory of tasks depend on. A join on a busy key is split even
# where that costs the aggregate above it a shuffle of partial results.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # What goes to Python comes in batches of so many bytes, however long the texts are. A batch is held several times
    # outside of the heap: by the task that writes it, by its worker and by the task that reads the answer.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


def build_session(app: str = "storelens", master: str | None = None,
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job relies on.

    Adaptive execution merges small shuffle partitions, so ``shuffle_partitions`` is an upper
    bound: on a large cluster give a few times the number of cores.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in RUNTIME.items():
        builder = builder.config(key, value)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> None:
    """Bring a session made elsewhere to the settings of ``build_session``, and put the folder of this
    package on the path of its Python workers."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "")
    if _PACKAGE_ROOT not in paths.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [_PACKAGE_ROOT, paths]))


def shared_dir(spark: SparkSession) -> str:
    """Root folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where the setting is missing a temporary folder is used, but only in local mode.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _LOCAL_ROOTS:
        root = _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="run-")
        # The folder is this process's own and goes with it.
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    return _LOCAL_ROOTS[context.applicationId]


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared root; nothing is created yet.

    Folders of a session lie under the name of its application, for ``clear_work`` to find.
    """
    return f"{_session_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _session_dir(spark: SparkSession) -> str:
    application = spark.sparkContext.applicationId
    folder = f"{shared_dir(spark)}/storelens/{application}"
    if application not in _STAGED:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        _STAGED[application] = lambda: files.delete(path, True)
        atexit.register(_clear, application)
    return folder


def clear_work(spark: SparkSession) -> None:
    """Delete what the session has staged under the shared root; results that are still lazy can't be
    read any more. Else this happens when the process ends."""
    _clear(spark.sparkContext.applicationId)


def _clear(application: str) -> None:
    delete = _STAGED.pop(application, None)
    if delete:
        with contextlib.suppress(Py4JError, OSError):  # the JVM may have ended before
            delete()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable, keeping a folder the cluster already set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_dir(spark)}/checkpoints")
