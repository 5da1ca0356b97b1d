"""Session helpers: a local session for scripts and tests, and the shared scratch folder."""

from __future__ import annotations

import logging
import tempfile
import uuid

from pyspark.sql import SparkSession

log = logging.getLogger(__name__)


def local_session(cores: int | str = "*", app: str = "clicklens", **conf: str) -> SparkSession:
    """A ``local[cores]`` session for scripts and tests (UI off, AQE on).

    Library code never calls this: it works on whatever session it is given.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)  # keeps a configured spark.checkpoint.dir; sets one only if unset
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Falls back to the context's checkpoint directory; when neither is set (a
    bare local session, as in tests) a local folder is created and set.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            # A machine-local folder is not visible to the other nodes.
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        d = tempfile.mkdtemp(prefix="clicklens-ckpt-")
        log.warning("spark.checkpoint.dir is unset; local session, using %s", d)
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder (nothing is created)."""
    return f"{shared_dir(spark)}/clicklens-scratch/{name}-{uuid.uuid4().hex[:12]}"
