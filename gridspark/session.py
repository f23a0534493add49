"""Session settings the library relies on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession

# Legacy charsets are needed for windows-31j; the error action makes a damaged
# byte decode to the replacement character instead of failing the job.
RUNTIME_CONF = {
    "spark.sql.legacy.javaCharsets": "true",
    "spark.sql.legacy.codingErrorAction": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session somebody else built."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", app_name: str = "gridspark") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", "8" if cores == "*" else cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's checkpoint folder; only a local session gets one of its own."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="gridspark-checkpoint-"))


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it; only a local session gets its own."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    ensure_checkpoint_dir(spark)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder that goes when the application ends."""
    place = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return place


@contextmanager
def evaluated_once(df: DataFrame) -> Iterator[DataFrame]:
    """The rows written to the shared folder and read back, for work that needs them more than once."""
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/batch-{uuid.uuid4().hex}"
    try:
        df.write.parquet(folder)
        yield spark.read.schema(df.schema).parquet(folder)
    finally:
        remove_folder(spark, folder)


def observed(seen: Observation, *names: str) -> dict[str, int]:
    """Counts that an observation took. A plan that turns out to be empty loses its counters; then all are 0."""
    try:
        found = seen.get
    except Py4JJavaError:
        found = {}
    return {name: int(found.get(name) or 0) for name in names}


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none where it does not exist."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in system.listStatus(path)] if system.exists(path) else []


def create_exclusively(spark: SparkSession, place: str, text: str) -> bool:
    """Write a small file whole under a name that must be new; false if the name is taken."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(place)
    hidden = jvm.org.apache.hadoop.fs.Path(path.getParent(), f".{path.getName()}-{uuid.uuid4().hex}")
    system = path.getFileSystem(conf)
    out = system.create(hidden)
    out.write(bytearray(text.encode()))
    out.close()
    none = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), conf).rename(hidden, path, none)
    except Py4JJavaError as error:
        system.delete(hidden, False)
        if "FileAlreadyExists" in str(error.java_exception):
            return False
        raise
    return True
