"""Session helpers: the shared folder and lineage cuts."""
from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

from veilspark.plans.errors import RunError


def local_session(cores: str = "8", memory: str = "8g", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("veilspark")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config(SPREAD, cores)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    return s


def on_one_machine(spark: SparkSession) -> bool:
    """Whether driver and tasks share one machine's folders."""
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Only where that setting is absent on one machine (tests) a temporary folder is made
    and set as the checkpoint folder; on a cluster it must be set.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        d = jdir.get() if jdir.isDefined() else None
        if not d:
            if not on_one_machine(spark):
                raise RunError("CONFIG_INVALID_VALUE", "spark.checkpoint.dir must name a folder that all executors share")
            d = tempfile.mkdtemp(prefix="veilspark-")
            spark.sparkContext.setCheckpointDir(d)
    return d


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it from there.

    A reliable checkpoint: it survives the loss of any executor, and Spark removes
    the files when the frame is no longer referenced.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Setting: over how many partitions inputs are spread before costly work on their rows; 0 leaves them as they are read.
SPREAD = "spark.veilspark.spread"


def spread(df: DataFrame, key: str | None = None) -> DataFrame:
    """``df`` over as many partitions as the setting ``SPREAD`` says, if it says so.

    For inputs of fewer splits than cores, such as the one-file tables of tests and
    benchmarks; large inputs need none, so it is off unless set.
    """
    n = int(df.sparkSession.conf.get(SPREAD, "0"))
    if n <= 1:
        return df
    return df.repartition(n, key) if key else df.repartition(n)
