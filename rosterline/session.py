"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Only what differs from Spark's own defaults. Adaptive execution splits the
# partition of a hot join key; `forceOptimizeSkewedJoin` lets it do so even when
# that costs one more exchange further up the plan.
SESSION_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session, leaving anything the cluster has set.

    The time zone is always UTC: load dates and epoch conversions must not move
    with the machine the driver happens to run on.
    """
    for key, value in SESSION_SETTINGS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_local_folder: str | None = None


def use_local_folder(path: str) -> None:
    """Name the folder that sessions without a cluster stage intermediate tables in."""
    global _local_folder
    _local_folder = path


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables that all executors see: `spark.checkpoint.dir`.

    Only where every task runs in the driver's process may it be one that
    `use_local_folder` has named.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and spark.sparkContext.master.startswith("local["):
        folder = _local_folder
    if not folder:
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return folder.rstrip("/")


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    """Create (or fetch) a configured session; `settings` use `__` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())
