"""Spark session helpers.

Operators never create sessions; they take DataFrames. These helpers are for
tests, the bench and the command line, and for code that needs a shared
folder to cut lineage (``spark.checkpoint.dir``).
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every session of this library relies on: UTC session time zone
# (block timestamps are UTC), AQE for runtime re-planning (coalescing, skew
# join splitting, broadcast only after the runtime size is known).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "gapseries",
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    # Python workers (the stateful stream processor) import this package:
    # in local mode they inherit the JVM's environment. On a cluster ship
    # the package with --py-files / spark.submit.pyFiles instead.
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    parts = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in parts:
        os.environ["PYTHONPATH"] = os.pathsep.join([root, *parts])
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = "8g"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared (distributed) folder
    and is used as is; without it this raises, as a folder of the driver's
    machine would be missing on the executors. Only a local master (tests, the
    bench) gets a scratch folder of its own.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the conf alone names the folder
        sc = None
    if not current and sc is not None:
        current = sc.getCheckpointDir()
    if not current:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share (master {master!r})")
        current = tempfile.mkdtemp(prefix="gapseries-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if sc is not None:
        sc.setCheckpointDir(current)
    return current


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never local)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name)


def sizing_conf(input_bytes: int, executor_cores_total: int, target_partition_bytes: int = 256 << 20,
                max_split_bytes: int = 512 << 20) -> dict[str, str]:
    """Cluster settings sized from the input volume (apply with ``spark.conf.set``).

    Shuffle partitions: enough that each holds about ``target_partition_bytes``
    (so sorts and windows fit executor memory and spill rarely), at least
    twice the cores; AQE then coalesces small ones and splits skewed ones.
    Scan splits of ``max_split_bytes`` keep the task count of a 100 TB scan
    in the hundreds of thousands, not millions.
    """
    parts = max(2 * executor_cores_total, -(-int(input_bytes) // int(target_partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(max_split_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        # runtime broadcast only below a fixed, small size: the proven bound for joins
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.session.timeZone": "UTC",
    }
