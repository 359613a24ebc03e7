"""Session helpers: one place for the configs every job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter for correctness/scale of every plan in this package.
# AQE re-plans joins from real shuffle sizes (runtime broadcast, skew split,
# partition coalescing); the rest keep local runs quiet and deterministic.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "shelfwise",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    On a cluster ``master`` is left to ``spark-submit``; tests pass
    ``local[*]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session; only when it is unset
    on a ``local`` master is a scratch folder created and set; elsewhere that is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no SparkContext (Spark Connect): conf only
        sc = None
    current = None
    if sc is not None:
        d = d or sc.getConf().get("spark.checkpoint.dir", None)
        current = sc._jsc.sc().getCheckpointDir()
        if not d and not current.isEmpty():
            d = current.get()
    if not d and not (sc is not None and sc.master.split("[")[0] == "local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="shelfwise-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # noqa: BLE001 - core conf may be read-only at runtime
            pass
    if current is not None and current.isEmpty():
        sc.setCheckpointDir(d)
    return d
