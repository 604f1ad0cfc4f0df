"""Session construction.

Library code never creates a session itself; callers hand one in. This helper is
for tests, the bench and command-line use, and only sets what is not set already.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # checkpoint files are deleted once their DataFrame is garbage-collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "riskladder",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A session for tests, the bench and local runs (AQE on, UI off); existing settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session; a folder of our own is set
    only when the setting is absent and the master is local (tests). On a cluster
    the setting must point at shared storage; without it this raises.
    """
    try:
        sc = spark.sparkContext
    except Exception:                      # Spark Connect: the server owns the folder
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    active = sc.getCheckpointDir()
    if active:
        return active
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    path = configured or fallback
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: point it at a folder shared by all "
                               "executors (a machine-local folder does not survive executor loss)")
        path = tempfile.mkdtemp(prefix="riskladder-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def materialize(df):
    """Compute ``df`` once and cut its lineage (reliable checkpoint, shared folder).

    Used where one intermediate feeds two branches of a plan (a self-join, an
    aggregate joined back): both branches then read the checkpoint instead of
    recomputing the upstream, and a lost executor re-reads it rather than
    recomputing the return-series aggregation.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
