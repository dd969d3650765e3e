"""Session settings that the library relies on."""

import os

from pyspark.sql import SparkSession


def local_session(cpus: int | None = None, app: str = "lawloom") -> SparkSession:
    """Session for tests and benches; a cluster brings its own."""
    cores = str(cpus) if cpus else "*"
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus or os.cpu_count() or 8))
        .config("spark.sql.files.minPartitionNum", cores if cpus else str(os.cpu_count() or 8))
        .config("spark.sql.files.openCostInBytes", "65536")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
