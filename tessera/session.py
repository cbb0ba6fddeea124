"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Only settings that differ from Spark's own defaults. AQE (coalescing, skew joins, runtime
# broadcast conversion) is on by default and relied upon throughout.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # The JVM does not compile methods above 8000 bytes; wide conditional aggregates exceed that as
    # one fused method and are several times faster as separate generated projections.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_spark(app: str = "tessera", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators assume to a session we were handed."""
    for key, value in DEFAULTS.items():
        spark.conf.set(key, value)
    ship(spark)
    return spark


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give executors this package once per application, for the few operators that run Python there."""
    context = spark.sparkContext
    if context.master.startswith("local[") or context.master == "local" or context.applicationId in _SHIPPED:
        return
    _SHIPPED.add(context.applicationId)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="spark-"), "tessera.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "tessera")):
            for name in names:
                if name.endswith(".py"):
                    z.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), root))
    context.addPyFile(archive)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder that every executor can reach.

    The cluster names its shared folder in ``spark.checkpoint.dir``. Where that is unset, a local
    session, as in tests, gets a temporary folder; on a cluster that would be lost data.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return os.path.join(base, "tessera", f"{name}-{uuid.uuid4().hex}")
