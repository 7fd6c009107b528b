"""Session helpers shared by every subpackage: tables, lineage cuts, shared folders."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


#: Batches that go to Python workers: (the setting's default, ours). Texts are long, so rows and bytes of a batch are bounded lower.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000")}

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    for name, (usual, ours) in BATCHES.items():
        if spark.conf.get(name, usual) == usual:
            spark.conf.set(name, ours)
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="gneiss-code-")) / "gneiss_code.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, str(file.relative_to(package.parent)))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table. Only Spark opens the path, so any store Spark can read will do."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    A cluster names it in spark.checkpoint.dir. Only where that is unset (local tests) a
    temporary folder of this machine is made and set.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="gneiss-checkpoint-"))
    return context._jsc.sc().getCheckpointDir().get().rstrip("/")


_written: list[tuple[SparkSession, str]] = []


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage ends there.

    A lost executor loses nothing, since the table is in the shared store. Tables of a
    session are removed by release() or when the driver's Python ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint for small frames of iterative operators."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def release() -> None:
    """Delete the tables that materialize() has written."""
    while _written:
        spark, path = _written.pop()
        try:
            jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(conf).delete(target, True)
        except Exception:  # the JVM may have gone before the driver's Python
            return


atexit.register(release)
