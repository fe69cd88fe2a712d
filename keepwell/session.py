"""Session construction and the one way this library cuts lineage."""

from __future__ import annotations

import atexit
import pkgutil
import re
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterable
from pathlib import Path

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "keepwell", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs are written for; ``conf`` wins."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.showConsoleProgress": "false",
        # call sites are not recorded per expression: plans here have thousands
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Where that is unset, a folder beside the warehouse's tables, which are shared as well.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    named = named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return re.sub("^file:/+", "file:///", named).rstrip("/")


def scratch(spark: SparkSession, kind: str) -> str:
    """A new folder inside the shared one; it goes when the session's JVM ends."""
    path = f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(hadoop)
    files.deleteOnExit(hadoop)
    return path


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder and read it from there.

    For wide or large frames that feed several branches: each branch reads only its
    columns, and the lineage ends here.
    """
    path = scratch(df.sparkSession, "table")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: the name under which plans write a frame that feeds several branches
materialize = written


def size_partitions(spark: SparkSession, *paths: str, partition_bytes: int = 128 << 20) -> int:
    """Set the number of shuffle partitions from the size of the inputs; never less than it was.

    Sizes come from the store's own file system, without a job.
    """
    total = 0
    for path in paths:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
        total += files.getContentSummary(hadoop).getLength()
    wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // partition_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", wanted)
    return wanted


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application.

    Called wherever a function of the package runs in tasks, since executors
    know nothing of the driver's import path.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="keepwell-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)  # it is served from here until then
    context.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name))
    _SHIPPED.add(context.applicationId)


_COMPILED: dict[tuple[str, str, str], JavaObject] = {}


def java_classes(spark: SparkSession, package: str, source: str) -> JavaObject:
    """The class loader of a Java file of this package, compiled and given to the executors once per application.

    Spark brings the compiler along (Janino, which compiles its generated code), so nothing has to be built or installed.
    """
    context = spark.sparkContext
    key = context.applicationId, package, source
    if key not in _COMPILED:
        compiler = context._jvm.org.codehaus.janino.SimpleCompiler()
        compiler.setParentClassLoader(context._jvm.Thread.currentThread().getContextClassLoader())
        compiler.cook(pkgutil.get_data(package, source).decode())
        folder = tempfile.mkdtemp(prefix="keepwell-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)  # it is served from here until then
        jar = f"{folder}/{Path(source).stem}-{uuid.uuid4().hex}.jar"
        with zipfile.ZipFile(jar, "w") as out:
            for name, code in compiler.getBytecodes().items():
                out.writestr(f"{name.replace('.', '/')}.class", bytes(code))
        context._jsc.addJar(jar)
        _COMPILED[key] = compiler.getClassLoader()
    return _COMPILED[key]


def java_array(spark: SparkSession, items: Iterable) -> JavaObject:
    """An Object[]."""
    items = list(items)
    out = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.java.lang.Object, len(items))
    for i, item in enumerate(items):
        if item is not None:
            out[i] = item
    return out
