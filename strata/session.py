"""Session helpers: a tuned local session for tests and a shared scratch folder.

Scratch data (landing files made by the example jobs, checkpoints, written
tables) always lives below the cluster's ``spark.checkpoint.dir``. Only when
that setting is absent *and* the master is local (tests, a laptop) do we make
our own folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "strata") -> SparkSession:
    """A session with AQE, UTC and the UI off; sized for ``local[N]``."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    parts = shuffle_partitions or int(os.environ.get("STRATA_SHUFFLE_PARTITIONS", "8"))
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("STRATA_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's reliable checkpoint folder, set up if needed.

    Order: an already set checkpoint dir; else ``spark.checkpoint.dir`` from the
    conf; else, on a local master only, a fresh temp folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master == "local" or sc.master.startswith("local["):     # not local-cluster
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="strata-ckpt-"))
    else:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a shared folder is required on a cluster")
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unique folder path below the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/strata-scratch/{label}-{uuid.uuid4().hex[:12]}"
