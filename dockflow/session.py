"""Optional SparkSession builder for local runs, tests and the bench.

Library operators never require it: they take and return DataFrames and work
under whatever session the caller has (cluster settings, time zone, ANSI).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(app: str = "dockflow", cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", min_partition_size: str = "256KB") -> SparkSession:
    """A local session tuned for small data: AQE on, few shuffle partitions, no UI."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # Small local inputs: let AQE keep more, smaller shuffle partitions so
        # all cores work (the cluster default of 1MB would merge them into 1-2).
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", min_partition_size)
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared, durable folder and is
    used as is; if it is missing there, this raises rather than fall back to a
    machine-local folder. Only for a ``local[...]`` master with nothing
    configured (tests, the bench) a fresh folder is made under the system temp
    directory.
    """
    current = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a shared folder for intermediate tables")
    path = tempfile.mkdtemp(prefix="dockflow-ckpt-")
    spark.conf.set(CHECKPOINT_CONF, path)
    spark.sparkContext.setCheckpointDir(path)
    return spark.sparkContext.getCheckpointDir() or path


def ship(spark: SparkSession) -> None:
    """Let Python workers of a local session import this package from any folder.

    On a cluster the package is installed or passed with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH")) if x)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the checkpoint folder for an intermediate table."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{os.urandom(6).hex()}")


def settled(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the checkpoint folder and read back: it outlives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scale_conf(input_bytes: int, total_cores: int, *, scan_split_bytes: int = 2 << 30,
               shuffle_target_bytes: int = 2 << 30) -> dict[str, str]:
    """Partition settings for a cluster run, from input size and core count.

    Scan splits of ``scan_split_bytes``; the initial shuffle partition count
    sized so the largest shuffle (de-duplication carries about the whole
    projected input) gets ``shuffle_target_bytes`` per partition and at least
    two waves of tasks, leaving AQE to coalesce small stages and split skewed
    ones. A shuffle of M map and R reduce tasks moves M x R blocks, so both
    sizes grow with the input: at 100 TB the defaults give 51,200 x 51,200 = 2.6
    billion blocks of about 40 KB; splits of 256 MB would give 168 billion of
    600 bytes, which no shuffle service survives. A task sorts 2 GB by spilling.
    Pass the result to ``SparkSession.builder.config(map=...)`` or
    ``spark.conf.set``.
    """
    shuffle_parts = max(2 * total_cores, -(-input_bytes // shuffle_target_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(scan_split_bytes),
        "spark.sql.shuffle.partitions": str(shuffle_parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(shuffle_target_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        # row_number() = 1 de-duplication keeps one row per key before the shuffle.
        "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
    }
