"""Session and scratch-location helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


CODEGEN_MAX_FIELDS = 1000


def get_spark(master: str | None = None, app_name: str = "flightdeck",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the engine relies on.

    AQE stays on so the runtime can coalesce small shuffles, switch a join to
    broadcast once the real size of a side is known, and split skewed join
    partitions.  The session time zone is pinned so date derivations from
    timestamps do not depend on the host.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    # The staging conversion compiles to methods above HotSpot's 8000-byte
    # JIT limit (62 wide columns); let the JIT compile them instead of
    # interpreting them (about 2.5x faster on the conversion stages).
    jit = "-XX:-DontCompileHugeMethods"
    builder = (builder
               # the conversion's parse projection and the one-pass profiles
               # carry ~110-190 columns; above the default of 100 Spark drops
               # whole-stage codegen for the stage (about 2x slower there)
               .config("spark.sql.codegen.maxFields", str(CODEGEN_MAX_FIELDS))
               .config("spark.driver.extraJavaOptions", jit)
               .config("spark.executor.extraJavaOptions", jit)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def compile_in_parts(spark: SparkSession) -> None:
    """Have wide stages compiled as methods that the JVM's JIT accepts.

    HotSpot interprets a method above 8,000 bytes of bytecode.  A whole-stage method
    above that limit (the 62-column rendering and conversion) is given up for the
    operators' own code, which Spark splits into small methods.  Sessions that let the
    JIT compile huge methods (:func:`get_spark`) need no limit.
    """
    conf = spark.sparkContext.getConf()
    local = spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster")
    options = conf.get(f"spark.{'driver' if local else 'executor'}.extraJavaOptions", "")
    if "-DontCompileHugeMethods" not in options:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def checkpoint_root(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    The location is read from ``spark.checkpoint.dir`` (or the directory the
    SparkContext already uses).  Only when neither is set and the master is
    local -- a test run -- a private folder is created and registered; a cluster
    without a named folder is an error, for its executors could not read it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="flightdeck-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        return root
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/flightdeck/{name}-{uuid.uuid4().hex}"
