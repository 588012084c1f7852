"""Session set-up and lineage cuts that survive the loss of an executor."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
_written: list[tuple[SparkSession, str]] = []


def local_session(cores: int = 8, partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("callweave")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once an application, so that Python workers can import it anywhere."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    home = Path(__file__).resolve().parent
    packed = Path(tempfile.mkdtemp(prefix="callweave-")) / "callweave.zip"
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for path in sorted(home.rglob("*.py")):
            z.write(path, path.relative_to(home.parent))
    context.addPyFile(str(packed))
    _shipped.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or, where that is unset and the master is local, a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="callweave-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch(spark: SparkSession, suffix: str = "") -> str:
    """A new path in the shared folder, removed when the driver ends."""
    path = f"{shared_folder(spark)}/callweave-{uuid.uuid4().hex}{suffix}"
    if not _written:
        atexit.register(_sweep)
    _written.append((spark, path))
    return path


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: a lineage cut that no lost executor can undo.

    Parquet rather than ``checkpoint()``: it is compressed, and later reads prune columns. The folders are
    removed when the driver ends.
    """
    spark = df.sparkSession
    path = scratch(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _sweep() -> None:
    for spark, path in _written:
        try:
            jvm = spark.sparkContext._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # noqa: BLE001 - the JVM may be gone already
            return
