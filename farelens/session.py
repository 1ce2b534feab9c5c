"""Session settings and the shared folders jobs may write to."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from pathlib import Path

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Runtime settings every plan in this package is written for.  They can all be set
# on a running session; memory, cores and shuffle partitions stay with the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when a later aggregate has to shuffle again.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Batches for Python tasks stay small also where rows are whole texts, or chunks of them: a
    # task holds one in the JVM's buffers, which double as they grow, and one in its worker.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "farelens", memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        # Call-site capture per column expression; only error texts would use it.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Apply ``SETTINGS`` to a session somebody else built, and ship the package to it."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    ship(spark)
    return spark


@contextmanager
def co_located(spark: SparkSession) -> Iterator[None]:
    """Plan joins where both sides are in the same buckets of some of their keys without a
    shuffle.

    Only for what runs inside: elsewhere a side that is grouped by part of the keys would decide
    how the other one is dealt, which undoes ``spread_join``.
    """
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name, "true")
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the Python workers, once per application.

    Functions of Python tasks are pickled by module name, so workers need the modules also
    where the package is not installed on every machine.
    """
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="farelens-")) / "farelens.zip"
    with zipfile.ZipFile(path, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(path))
    _SHIPPED.add(application)


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and scratch tables, readable by every executor.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local master may leave it
    unset; a folder of our own is then used.  Executors of a cluster would each write such a
    folder on their own disk, hence the error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if named is None:
            if not spark.sparkContext.master.startswith("local") or (
                    spark.sparkContext.master.startswith("local-cluster")):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            named = "file://" + tempfile.mkdtemp(prefix="farelens-")
        spark.sparkContext.setCheckpointDir(named)
        current = spark.sparkContext.getCheckpointDir()
    return named or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a reliable checkpoint."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def apart(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """A session with the settings of ``spark`` but for these, for frames that are planned later
    than here and need them.  Other queries of ``spark`` do not get to see them."""
    other = spark.newSession()
    for key, value in (spark.conf.getAll | settings).items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            other.conf.set(key, value)
    return other


def side_by_side(spark: SparkSession, *steps: Callable[[], object]) -> list:
    """Results of steps that do not need each other, whose jobs run at the same time.

    Fitting a model is a long row of small jobs, with cores idle between them.  What the steps
    share has to be stored before, and no step may change settings.
    """
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
        return [step.result() for step in running]
