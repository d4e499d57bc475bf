"""Session construction, table access and lineage cutting."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "pagelode", cores: int | str = 8, partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks. On a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("PAGELODE_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application, so that Python operators run anywhere."""
    sc = spark.sparkContext
    if hasattr(sc, "_pagelode_shipped"):
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="pagelode-ship-")  # the driver's; executors fetch the file from it
    atexit.register(shutil.rmtree, folder, True)
    target = Path(folder) / "pagelode.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, str(Path(root.name) / p.relative_to(root)))
    sc.addPyFile(str(target))
    sc._pagelode_shipped = True


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One table of a dataset folder laid out as ``<base>/<name>.parquet``."""
    ship_package(spark)
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def _is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process, so that a folder of this machine is seen by all of them."""
    return re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session, else what ``setCheckpointDir`` named.

    Only in local mode (tests) may both be missing; then a folder of this machine is used. A cluster without a shared
    folder is an error: parts written to the disks of its machines would be lost to each other.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
    if not hasattr(sc, "_pagelode_dir"):
        sc._pagelode_dir = tempfile.mkdtemp(prefix="pagelode-")
        atexit.register(shutil.rmtree, sc._pagelode_dir, True)
    return "file://" + sc._pagelode_dir


class _Scratch:
    """Tables written by ``materialize`` in one application, each with a weak reference to the relation that reads it."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.app, self.held, self.roots = spark.sparkContext.applicationId, {}, set()

    def drop(self, path: str) -> None:
        try:
            target = self.jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(self.hadoop).delete(target, True)
        except Exception:  # the gateway may be gone already
            pass

    def path(self, root: str, label: str) -> str:
        folder = f"{root}/pagelode/{self.app}"
        if folder not in self.roots:
            self.roots.add(folder)
            atexit.register(self.drop, folder)
        return f"{folder}/{label}-{uuid.uuid4().hex}"

    def hold(self, path: str, df: DataFrame) -> None:
        """Remembers the relation: every plan over the table shares it, so once it is gone nothing can read the table."""
        relation = df._jdf.queryExecution().analyzed().relation()
        self.held[path] = self.jvm.java.lang.ref.WeakReference(relation)

    def sweep(self) -> list[str]:
        gone = [p for p, ref in self.held.items() if ref.get() is None]
        for p in gone:
            self.drop(p)
            del self.held[p]
        return gone


def _scratch(spark: SparkSession) -> _Scratch:
    sc = spark.sparkContext
    if not hasattr(sc, "_pagelode_scratch"):
        sc._pagelode_scratch = _Scratch(spark)
    return sc._pagelode_scratch


def sweep(spark: SparkSession) -> list[str]:
    """Deletes the tables of ``materialize`` that no plan refers to any more; gives their paths."""
    return _scratch(spark).sweep()


def materialize(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back, cutting its lineage.

    Unlike an eager ``checkpoint()`` the input is computed once and later readers prune columns. The files survive the
    loss of any executor. A table goes when no plan refers to it any more (looked up at each call), all at the driver's end.
    """
    spark = df.sparkSession
    scratch = _scratch(spark)
    scratch.sweep()
    path = scratch.path(shared_dir(spark), label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    scratch.hold(path, out)
    return out
