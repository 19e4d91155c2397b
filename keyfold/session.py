"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A nested object may repeat a key; the last one wins, as for top-level keys.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # The call site of every column expression costs more than the expression itself.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", app: str = "keyfold", **conf: str) -> SparkSession:
    """Session for tests, the bench and local runs; a cluster brings its own through spark-submit."""
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="keyfold-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
