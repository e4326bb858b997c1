"""Session helpers: table access and lineage cuts on the shared checkpoint folder."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir of the session.

    Only in local mode, where the session may name none, a temporary folder is used.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not configured:
        configured = getattr(spark, "_sitewright_scratch", None)
        if configured is None:
            configured = spark._sitewright_scratch = "file://" + tempfile.mkdtemp(prefix="spark-sitewright-")
    return configured.rstrip("/")


def free_driver_memory(spark: SparkSession) -> bool:
    """Give back what finished jobs have left in the driver; False if the JVM cannot trim its native heap.

    Spark removes broadcasts and shuffle files only when the driver collects their handles. What compilers and
    threads of the JVM have freed stays with the C library, some MB more for every job, until the heap is trimmed.
    """
    gc.collect()
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    jvm.System.gc()
    server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
    given = gateway.new_array(jvm.Object, 4)
    try:  # by reflection: the server's own class is not open to py4j
        given[0], given[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        invoke = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
        invoke.invoke(server, given)
    except Py4JError:  # a JVM before 17.0.9, or no glibc
        return False
    return True


class Workspace:
    """Tables of one job below the shared folder; a table written there cuts the lineage.

    Unlike localCheckpoint the files survive the loss of any executor.
    """

    def __init__(self, spark: SparkSession, label: str, root: str | None = None):
        """A new folder, or the one at root, which may hold tables already."""
        self.spark = spark
        self.root = root or f"{shared_dir(spark)}/sitewright-{label}-{uuid.uuid4().hex[:12]}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str, mode: str = "overwrite") -> DataFrame:
        df.write.mode(mode).parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    @classmethod
    def settle(cls, df: DataFrame, work: Workspace | None, name: str) -> DataFrame:
        """df read back from a table of work, so that what uses it several times computes it once; df itself without work."""
        return df if work is None else work.write(df, name)

    def _file_system(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def drop(self, name: str) -> None:
        """Remove a table that nothing reads any more."""
        fs, path = self._file_system(name)
        fs.delete(path, True)

    def write_text(self, name: str, text: str) -> None:
        """A small file, replaced as a whole."""
        fs, path = self._file_system(name + ".new")
        out = fs.create(path, True)
        out.write(bytearray(text.encode()))
        out.close()
        final = self._file_system(name)[1]
        fs.delete(final, False)
        fs.rename(path, final)

    def read_text(self, name: str) -> str | None:
        """A small file, or None; one whose replacement was cut short is found under its new name."""
        for candidate in (name, name + ".new"):
            fs, path = self._file_system(candidate)
            if fs.exists(path):
                stream = fs.open(path)
                text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
                stream.close()
                return text
        return None
