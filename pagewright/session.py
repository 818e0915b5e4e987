"""Sessions, table access and the shared folder that survives executors."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, name: str = "pagewright") -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables as a DataFrame over parquet."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, and where that is unset, on this machine alone, one that ends with the driver."""
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        return conf
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir isn't set: executors of a cluster need a folder that all of them share")
    import atexit
    import shutil
    import tempfile

    made = "file://" + tempfile.mkdtemp(prefix="pagewright-")
    atexit.register(shutil.rmtree, made.removeprefix("file://"), ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df once into the shared folder and read it back, so that later stages don't recompute it and survive lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/pagewright/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
