"""Session settings and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Settings the operators rely on.  All can be set at run time; none changes results.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4000",
}


def build_session(master: str = "local[8]", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benches; on a cluster the caller brings its own."""
    builder = SparkSession.builder.master(master).appName("quillsieve").config("spark.sql.shuffle.partitions", partitions)
    builder = builder.config("spark.driver.memory", memory).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``; a folder of this machine only where Spark runs on it alone."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = _LOCAL.setdefault("folder", tempfile.mkdtemp(prefix="quillsieve-"))
    return folder


_LOCAL: dict[str, str] = {}


_CUT: list[str] = []


def drop_cut_tables(spark: SparkSession) -> int:
    """Delete the tables that this session cut lineage with, once their results aren't needed; returns how many there were."""
    count = len(_CUT)
    while _CUT:
        path = spark._jvm.org.apache.hadoop.fs.Path(_CUT.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return count


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table into the shared folder and read it back.

    What was computed once is then read, not computed again, and it survives the loss of any executor.  The table is
    columnar, so later stages read only the columns they need.
    """
    path = f"{shared_folder(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    _CUT.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """A scanned frame with at least as many partitions as there are cores, for work that is heavy per row.

    Small inputs in few files are shuffled for that; inputs with more partitions than cores are left as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def ship_package(spark: SparkSession) -> None:
    """Let the Python workers of every executor import this package, wherever they run; once per application."""
    context = spark.sparkContext
    if _LOCAL.get("shipped") != context.applicationId:
        root = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="quillsieve-")) / "quillsieve.zip"
        with zipfile.ZipFile(archive, "w") as packed:
            for path in sorted(root.rglob("*.py")):
                packed.write(path, path.relative_to(root.parent))
        context.addPyFile(str(archive))
        _LOCAL["shipped"] = context.applicationId


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
