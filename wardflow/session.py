"""Session settings the library relies on."""

from __future__ import annotations

import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Runtime (per-session) settings that change results, not only speed:
# - all wall-clock logic (hour buckets, ISO parsing) is in UTC;
# - a repeated JSON key keeps its last value instead of failing the message.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Name of the session setting that ``spread`` reads.
SPREAD = "wardflow.spread"

# Speed settings for a session the library creates itself.  On a cluster the operator's
# own values win; nothing here is forced onto an existing session.
SPEED_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # call-site capture for every column operation: costs seconds on wide expressions
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to an existing session, and ship the package."""
    for key, value in RESULT_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Needed where it is only on the driver's path; a package given with ``--py-files`` is a zip
    already and is left alone.
    """
    context, package = spark.sparkContext, Path(__file__).resolve().parent
    archive = f"{package.name}.zip"
    if not package.is_dir() or any(f.endswith(f"/{archive}") for f in context.listFiles):
        return
    target = Path(tempfile.mkdtemp(prefix="wardflow-")) / archive
    with zipfile.ZipFile(target, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(target))


def local_session(cpus: int = 8, app: str = "wardflow", memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config(SPREAD, str(cpus))  # the test tables have one row group each
    )
    for key, value in {**SPEED_SETTINGS, **RESULT_SETTINGS}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for work tables and checkpoints.

    A cluster names it in ``spark.checkpoint.dir``.  Only where that is unset, as in local
    tests, a fresh local folder is made the session's checkpoint folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="wardflow-"))
    return context.getCheckpointDir()


def materialize(df: DataFrame, keep: bool = False) -> DataFrame:
    """``df`` written as a work table in the shared folder and read back.

    Cuts the lineage so that later steps do not repeat the work, survives lost executors, and
    gives the planner the measured size: whether it is broadcast follows from that.  With ``keep``
    it outlives the innermost ``work_tables`` around it, as the result of what is done there.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/work/{uuid.uuid4().hex}"
    around = getattr(_made, "open", [])
    for made in around[-2:-1] if keep else around[-1:]:
        made.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_made = threading.local()  # a stream's batches run in a thread of their own


@contextmanager
def work_tables(spark: SparkSession) -> Iterator[None]:
    """Deletes on leaving the work tables made inside, so nothing read from them may get out."""
    _made.open = [*getattr(_made, "open", []), []]
    try:
        yield
    finally:
        *_made.open, made = _made.open
        for path in made:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt out over as many tasks as the session's ``wardflow.spread`` says, if it does.

    For inputs of few row groups in front of costly work per row: the number is a statement of
    whoever starts the session, not a guess from sizes.  Unset, as on a cluster whose files
    have row groups enough, nothing is shuffled.
    """
    tasks = df.sparkSession.conf.get(SPREAD, None)
    return df.repartition(int(tasks), *keys) if tasks else df
