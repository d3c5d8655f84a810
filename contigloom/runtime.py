"""Session helpers: shared scratch space, lineage cuts and code shipping."""

from __future__ import annotations

import contextlib
import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

#: Lists of tables that keep() adds to, innermost last.
_collecting: list[list[DataFrame]] = []
_PACKAGE = Path(__file__).resolve().parent
_shipped: dict[str, bool] = {}


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application."""
    app = spark.sparkContext.applicationId
    if _shipped.get(app):
        return
    folder = Path(tempfile.mkdtemp(prefix="contigloom-"))
    archive = folder / "contigloom_code.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(_PACKAGE.rglob("*.py")):
            z.write(p, Path("contigloom") / p.relative_to(_PACKAGE))
    spark.sparkContext.addPyFile(os.path.realpath(archive))
    _shipped[app] = True


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or an own one in local mode."""
    conf = spark.sparkContext.getConf()
    base = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        set_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        if set_dir.isDefined():
            base = set_dir.get()
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = Path(tempfile.mkdtemp(prefix="contigloom-shared-")).as_uri()
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def _own(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/contigloom/{spark.sparkContext.applicationId}"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{_own(spark)}/{name}-{uuid.uuid4().hex}"


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Delete all that this application wrote to the shared folder; call it when no result is read any more."""
    _delete(spark, _own(spark))


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._kept_path = path
    if _collecting:
        _collecting[-1].append(out)
    trim_driver(df.sparkSession)
    return out


@contextlib.contextmanager
def passing(lasting: list[DataFrame]) -> Iterator[None]:
    """Tables that keep() writes inside are deleted at the end, but for those that are put into lasting."""
    made: list[DataFrame] = []
    _collecting.append(made)
    try:
        yield
    finally:
        _collecting.pop()
        for df in made:
            if any(df is x for x in lasting):
                if _collecting:
                    _collecting[-1].append(df)
            else:
                drop(df)


def drop(df: DataFrame) -> None:
    """Delete a table that keep() wrote and nothing reads any more."""
    path = getattr(df, "_kept_path", None)
    if path:
        _delete(df.sparkSession, path)


def trim() -> None:
    """Give memory that this process has freed back to the system."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass


def trim_driver(spark: SparkSession, share: float = 2 / 3) -> None:
    """Give memory that the driver has freed back to the system: Python's, the Java heap once it has grown beyond that share of its
    limit, and what the JVM has freed outside it, where its version has a command for that."""
    trim()
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    heap = jvm.java.lang.Runtime.getRuntime()
    if heap.totalMemory() > share * heap.maxMemory():
        jvm.java.lang.System.gc()
    server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
    invoke = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServerConnection").getMethods() if m.getName() == "invoke")
    told = gateway.new_array(jvm.java.lang.Object, 4)
    told[0], told[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
    told[2], told[3] = gateway.new_array(jvm.java.lang.Object, 0), gateway.new_array(jvm.java.lang.String, 0)
    with contextlib.suppress(Py4JJavaError):  # another JVM
        invoke.invoke(server, told)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over a task's batches that leaves its worker as small as it found it."""

    def tidied(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            trim()

    return tidied
