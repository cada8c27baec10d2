"""Session settings and the shared storage root.

Library functions never build a session; they take one. ``local_session`` is
for tests, the bench and the driver entry point only. ``storage_root`` is where
every table, landing directory and checkpoint of a run lives: the shared folder
named by ``spark.checkpoint.dir`` on a cluster, or a scratch folder that is
created (and registered as the checkpoint dir) only when the session has none.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the pipeline relies on. AQE coalesces small shuffle partitions and
# splits skewed ones, including inside REBALANCE (used before partitioned
# writes); dynamic overwrite replaces only the partitions present in the data.
PIPELINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
}

_ROOT_KEY = "spark.strata.root"

# Starting points for a large cluster (runtime SQL settings; apply with
# ``apply_conf``). Many shuffle partitions, coalesced by AQE, keep every reduce
# task small whatever the day's volume; the advisory size is also the target
# size of files written after a REBALANCE.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "32m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "strata") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in PIPELINE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_conf(spark: SparkSession, conf: dict[str, str] = PIPELINE_CONF) -> None:
    """Set runtime SQL settings (``PIPELINE_CONF``, ``CLUSTER_CONF``) on a session."""
    for k, v in conf.items():
        spark.conf.set(k, v)


def storage_root(spark: SparkSession) -> str:
    """Shared folder for tables and checkpoints of this session.

    Uses ``spark.checkpoint.dir`` when the cluster names one, else the folder a
    caller set with ``setCheckpointDir``. Only a local master without either
    (tests) gets a scratch folder, registered as the checkpoint directory so
    that ``DataFrame.checkpoint()`` works too; on a cluster a machine-local
    folder would be invisible to the other machines, so that is an error.
    """
    root = spark.conf.get(_ROOT_KEY, None)
    if root:
        return root
    sc = spark.sparkContext
    shared = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if shared:
        root = shared.rstrip("/") + "/strata"
    elif re.match(r"local(\[|$)", sc.master):
        root = tempfile.mkdtemp(prefix="strata-")
        sc.setCheckpointDir(root + "/_checkpoints")
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
    spark.conf.set(_ROOT_KEY, root)
    return root


def run_root(spark: SparkSession, label: str) -> str:
    """A fresh folder under the storage root for one run of a query."""
    return f"{storage_root(spark)}/runs/{label}-{uuid.uuid4().hex[:12]}"


def fresh_name(prefix: str) -> str:
    """A database name that does not collide with earlier runs."""
    return f"{prefix}_{uuid.uuid4().hex[:10]}"
