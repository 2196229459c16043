"""Session defaults and the shared work folder.

Jobs never pick a machine-local scratch folder on their own: anything that
must outlive a task (stream checkpoints, landed batches, lineage cuts) goes
under ``spark.checkpoint.dir``, which a cluster points at shared storage.
Only when that setting is missing (local runs, tests) do we set one.
"""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins and coalesces partitions
# at run time; skew-join splits hot partitions of sort-merge joins.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}


# Sizing for a large cluster reading ~100 TB (applied with profile="cluster").
# * scans: 256 MB splits -> ~400k map tasks over 100 TB; filters and column
#   pruning shrink what each task reads.
# * shuffles: map tasks x reduce partitions blocks have to be tracked and
#   fetched, so the number of partitions is set for each job from its own
#   shuffled bytes (``partitions_for``); the default suits an hourly run, and
#   AQE merges small partitions up to the advisory size.
# * streams keep one state store a partition: their number is separate
#   (``STREAM_PARTITIONS``) and fixed by the first run of a checkpoint; state
#   lives in RocksDB, not in the executors' heap.
# * skew: a partition is split when it is 5x the median and above 512 MB.
# * executor loss: decommissioning migrates shuffle and cached blocks off
#   leaving executors; stages retry lost tasks from lineage otherwise.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.shuffle.partitions": "2000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512MB",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
    "spark.storage.decommission.rddBlocks.enabled": "true",
}
STREAM_PARTITIONS = 200


def partitions_for(shuffled_bytes: int, target_bytes: int = 256 << 20, least: int = 200) -> int:
    """Shuffle partitions for a job that moves ``shuffled_bytes``."""
    return max(least, -(-shuffled_bytes // target_bytes))


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "nimbus", conf: dict | None = None,
                profile: str = "local") -> SparkSession:
    """Session with the library's defaults; ``profile="cluster"`` adds the
    large-cluster sizing above. ``conf`` overrides both."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    base = {**DEFAULT_CONF, **(CLUSTER_CONF if profile == "cluster" else {})}
    for k, v in {**base, **(conf or {})}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder. Only a local session without
    one gets a folder of its own; elsewhere the setting is required, as other
    machines cannot see a local folder."""
    sc = spark.sparkContext
    current = (sc.getConf().get("spark.checkpoint.dir", None)
               or spark.conf.get("spark.checkpoint.dir", None)
               or sc.getCheckpointDir())
    if not current:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        current = tempfile.mkdtemp(prefix="nimbus-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    # setCheckpointDir may add a unique sub-folder; keep the configured root.
    return current


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for one run."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so local helpers can use plain paths."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


def is_local_path(path: str) -> bool:
    return "://" not in path or path.startswith("file:")


def ship_package(spark: SparkSession) -> None:
    """Make ``nimbus`` importable in Python workers (``addPyFile`` of a zip).

    Only paths that run Python inside tasks (the keyed collect) need it;
    everything else is JVM-side expressions.
    """
    sc = spark.sparkContext
    if getattr(sc, "_nimbus_shipped", False):
        return
    import nimbus  # noqa: PLC0415 - the package imports this module
    pkg_parent = os.path.dirname(os.path.dirname(os.path.abspath(nimbus.__file__)))
    target = work_dir(spark, "pyfiles")
    if is_local_path(target):
        out = local_path(target)
        os.makedirs(out, exist_ok=True)
    else:
        # The zip is only read by the driver, which serves it to executors.
        out = tempfile.mkdtemp(prefix="nimbus-pyfiles-")
    archive = shutil.make_archive(os.path.join(out, "nimbus"), "zip", pkg_parent, "nimbus")
    sc.addPyFile(archive)
    sc._nimbus_shipped = True
