"""Session defaults and helpers that every operator shares."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

#: A side of a join is sent to every executor only up to this many rows; beyond it the join shuffles.
BROADCAST_ROWS = 200_000


def local_session(cores: str = "8", shuffle_partitions: int = 8, app: str = "ledgerloom") -> SparkSession:
    """A session for tests and the benchmark on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("LEDGERLOOM_DRIVER_MEMORY", "12g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint(df: DataFrame, eager: bool = True) -> DataFrame:
    """Write ``df`` to the shared folder in ``spark.checkpoint.dir`` and cut its lineage.

    The folder is read from the session. Only where the setting is absent, as in tests on one
    machine, a temporary folder is set.
    """
    _checkpoint_folder(df.sparkSession.sparkContext)
    return df.checkpoint(eager=eager)


def _checkpoint_folder(sc) -> str:
    """The session's checkpoint folder; set from the setting or, on one machine only, to a temporary one."""
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder:
            if not sc.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="ledgerloom-")
        sc.setCheckpointDir(folder)
    return sc._jsc.sc().getCheckpointDir().get()


def written(df: DataFrame, key: str, *partition_by: str) -> DataFrame:
    """``df`` written once a session to the checkpoint folder as a table and read from there.

    ``key`` names the result; a later call with the same key reads the same files. With
    ``partition_by`` a filter on those columns reads only their partitions.
    """
    spark = df.sparkSession
    known = spark.sparkContext.__dict__.setdefault("_ledgerloom_written", {})
    if key not in known:
        path = f"{_checkpoint_folder(spark.sparkContext)}/table-{uuid.uuid4().hex}"
        df.write.partitionBy(*partition_by).parquet(path)
        known[key] = path
    return spark.read.schema(df.schema).parquet(known[key])


def spread(df: DataFrame) -> DataFrame:
    """Give a scan of a few small files enough partitions for every core; larger scans stay as they are.

    Meant for scans that feed Python stages. The shuffle happens only where the input has fewer
    partitions than the cluster has cores, that is, on inputs of a few megabytes per core.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _shared_folder(sc) -> str | None:
    """A folder of this session in the shared one, if the session names one that is mounted here."""
    shared = (sc.getConf().get("spark.checkpoint.dir") or "").removeprefix("file://")
    if not shared.startswith("/"):
        return None
    try:
        os.makedirs(folder := os.path.join(shared, f"code-{uuid.uuid4().hex}"))
    except OSError:
        return None
    return folder


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once a session."""
    sc = spark.sparkContext
    if getattr(sc, "_ledgerloom_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    to = os.path.join(_shared_folder(sc) or tempfile.mkdtemp(prefix="ledgerloom-"), "ledgerloom.zip")
    with zipfile.ZipFile(to, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if not n.endswith(".pyc"):
                    p = os.path.join(folder, n)
                    z.write(p, os.path.join("ledgerloom", os.path.relpath(p, root)))
    sc.addPyFile(to)
    sc._ledgerloom_shipped = True


def fan_out(df: DataFrame, *by: str) -> DataFrame:
    """Rows over at least as many partitions as there are cores, by columns if given.

    For little data that takes Python long: the planner merges partitions by their bytes and would
    leave such a stage to one or two tasks. Partitions follow the session's setting, four a core at most.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(max(cores, min(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * cores)), *by)
