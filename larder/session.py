"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_local_workdir: str | None = None
_staged: list[str] = []
_shipped: set[str] = set()


def local_session(
    app: str = "larder", cpus: int | str = "*", partitions: int = 8, conf: dict[str, str] | None = None
) -> SparkSession:
    """A session for tests and local benchmarks. A cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cpus}]")
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return (
        builder
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``, the folder every executor can reach.

    Only in local mode may the setting be absent (unit tests): then a local folder is made.
    """
    global _local_workdir
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or "local-cluster" in spark.sparkContext.master:
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if _local_workdir is None:
            _local_workdir = tempfile.mkdtemp(prefix="larder-")
        root = _local_workdir
    return f"{root.rstrip('/')}/larder/{label}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the executors, so that Python functions find it wherever the job was started. Once per context."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="larder-package-")) / "larder.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the work folder and read it back.

    Cuts the lineage at a point that survives lost executors: whatever was computed
    before (a partition id, a model score) is fixed once and read from then on.
    """
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    _staged.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged_files_removed(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end of the block, what :func:`stage` wrote inside it.

    For jobs that store their result before the block ends; a lazy result that leaves the
    block would find its input gone.
    """
    start = len(_staged)
    try:
        yield
    finally:
        while len(_staged) > start:
            target = spark._jvm.org.apache.hadoop.fs.Path(_staged.pop())
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
