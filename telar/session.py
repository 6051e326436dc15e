"""Session helpers shared by operators and queries."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """The package sent to the executors' Python once per application, so that functions in UDFs can be imported there."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    here = Path(__file__).resolve().parent
    out = Path(tempfile.mkdtemp(prefix="telar-")) / "telar-package.zip"
    with zipfile.ZipFile(out, "w") as z:
        for f in sorted(here.rglob("*.py")):
            z.write(f, f.relative_to(here.parent))
    sc.addPyFile(str(out))
    _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The test table ``name`` below ``sf_dir``."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor can reach, for checkpoints and written tables.

    The cluster names it in ``spark.checkpoint.dir``. Only in local mode, where that may be unset, a temporary folder of
    this machine is used; elsewhere an unset one is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that every executor can reach")
        path = os.path.join(tempfile.gettempdir(), "telar-checkpoints")
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def cut(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: its lineage is cut, a lost executor loses nothing of
    it, and later steps prune its columns and know its size. ``dropped`` removes it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/telar-{uuid.uuid4().hex}"
    # The driver keeps the description of every plan; those of intermediate tables needn't be whole.
    name = "spark.sql.maxPlanStringLength"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "10000")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Removes the files of a ``cut`` table that no later step reads."""
    spark = df.sparkSession
    for file in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        if path.getName().startswith("telar-"):
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores. A scan of fewer splits than cores is a few megabytes, and dealt out row by row; larger scans
    have splits enough and are left alone, so that tables of size are never shuffled for this."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df


def local_session(cores: str = "8", app: str = "telar", **conf: str) -> SparkSession:
    """A local session with the settings tests and bench use."""
    b = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.files.openCostInBytes", str(256 * 1024))  # small test files are split over the cores
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
