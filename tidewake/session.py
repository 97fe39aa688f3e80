"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_dirs: dict[str, str] = {}


def get_session(app: str = "tidewake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    Cluster sizes (executors, memory, shuffle partitions) are left to
    spark-submit; pass them as ``conf`` for local work.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Larger generated methods are not compiled by the JVM; run such stages operator by operator.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names the shared folder. A session without that
    setting gets one folder of its own if it runs in this process alone (tests);
    elsewhere that is an error, because the other machines couldn't see it.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if context.applicationId not in _own_dirs:
            _own_dirs[context.applicationId] = tempfile.mkdtemp(prefix="tidewake-")
        base = _own_dirs[context.applicationId]
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, and safe when executors are lost.

    For results that several later steps read and that cost more to repeat than to store.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
