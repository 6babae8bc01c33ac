"""Session settings the library relies on."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# No master, memory or partition count: those belong to the cluster. AQE sizes the
# shuffles and splits skewed join partitions at run time.
CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "wellspark", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for name, value in {**CONF, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once for a Spark context.

    Functions that run there import their modules by name. Where the package is installed on all
    machines, or given to spark-submit with --py-files, this changes nothing.
    """
    context = spark.sparkContext
    if getattr(context, "_wellspark_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    # The driver's own file; Spark copies it to the executors.
    archive = os.path.join(tempfile.mkdtemp(prefix="wellspark-"), "wellspark.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    context._wellspark_shipped = True
