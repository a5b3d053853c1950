"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every salesmart job relies on. AQE re-plans joins and coalesces
# shuffle partitions from runtime sizes, and splits skewed join partitions.
# UTC pins timestamp <-> date conversions so Spark and the SQL oracle agree.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "salesmart",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Get or create a session with salesmart's defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; locally
    tests pass ``local[N]`` and a shuffle partition count close to N.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


_LOCAL_DIRS: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``; that value is used as is.
    Only when it is unset (local runs and tests) a fresh folder is made once
    per application and registered as the context's checkpoint directory
    (the conf itself cannot be changed on a running session).
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current
    sc = spark.sparkContext
    app = sc.applicationId
    if app not in _LOCAL_DIRS:
        existing = sc.getCheckpointDir()
        if existing:
            _LOCAL_DIRS[app] = existing
        else:
            if sc.master != "local" and not sc.master.startswith("local["):
                raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            path = tempfile.mkdtemp(prefix="salesmart-ckpt-")
            sc.setCheckpointDir(path)
            _LOCAL_DIRS[app] = path
    return _LOCAL_DIRS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for one output."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def materialize(df):
    """Write ``df`` to the shared checkpoint folder and continue from there.

    Used for small, expensive-to-rebuild intermediates (a daily series built
    from all order lines) in front of long stages such as model fits: a lost
    executor then re-reads the checkpoint instead of re-running the
    aggregation over the lines. Reliable checkpoint, never local.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
