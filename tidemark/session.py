"""Session settings: what the jobs expect of a session, and the session of tests and benchmark."""

from __future__ import annotations

from pyspark.sql import SparkSession

# A static broadcast is decided by file size.  Columnar files hold repeated values in almost no
# space, so the size is taken tenfold: only files below a tenth of the broadcast threshold are
# broadcast unseen, everything else by the size measured at run time.
#
# ANSI mode is what makes a value of the wrong type fail a load.
SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.fileCompressionFactor": "10",
    "spark.sql.session.timeZone": "UTC",
}


def cluster_settings(shuffled_bytes: int, cores: int) -> dict[str, str]:
    """Settings for a cluster, from the bytes its largest shuffle moves.

    Partitions of about 256 MB, but at least three waves of tasks; adaptive execution merges
    those that turn out small.
    """
    partitions = max(shuffled_bytes // (256 << 20), cores * 3, 1)
    return {
        **SETTINGS,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
