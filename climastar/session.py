"""Session helpers: shared work folders and the configuration we rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a cluster deployment is expected to carry.  They are applied only
# by ``local_session`` (tests, bench); on a cluster the operator owns them.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

_fallback_dirs: dict[int, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at storage every executor can reach, so
    written tables and checkpoints survive executor loss.  Only when it is
    unset and the master is local (tests) do we create a folder of our own
    and register it as the checkpoint directory; on a cluster a folder of one
    machine would lose rows, so an unset folder is an error there.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir.rstrip("/")
    try:
        sc = spark.sparkContext
    except Exception:          # remote (Connect) session: no driver context here
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    if sc is None or not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    key = id(sc)
    if key not in _fallback_dirs:
        _fallback_dirs[key] = tempfile.mkdtemp(prefix="climastar-ckpt-")
        sc.setCheckpointDir(_fallback_dirs[key])
    return _fallback_dirs[key]


def new_run_dir(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder under the shared root for one run."""
    return f"{shared_root(spark)}/climastar/{label}-{uuid.uuid4().hex[:12]}"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "climastar") -> SparkSession:
    """Session for tests and the benchmark (local mode)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_root(spark)
    return spark
