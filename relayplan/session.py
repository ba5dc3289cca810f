"""Session construction and shared-folder handling.

On a cluster the session is created by the platform; ``configure`` only fills
in settings that are still unset, so cluster-level choices always win.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings we rely on. They are applied only when the session does not
# already define them.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # AQE decides broadcast from measured shuffle sizes, not estimates.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Rows of whole texts are long: small batches bound what a Python worker
    # and the JVM hold of them at once.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # Lookups join a small key set (requests' URIs, ids) against a very large
    # inventory. A runtime bloom filter built from the key side prunes the
    # inventory scan before its shuffle; Spark injects it only when that scan
    # exceeds applicationSideScanSizeThreshold (10 GB), so allow key sides up
    # to 256 MB to build one (the filter itself is capped at 8 MB).
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "256MB",
}


def build_session(master: str | None = None, app: str = "relayplan",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Local/test session. Cluster jobs should use the platform's session."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false")
          .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
          .config("spark.driver.memory", os.environ.get("RELAYPLAN_DRIVER_MEM", "16g"))
          .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    for k, v in DEFAULTS.items():
        if spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)
    # keep time semantics fixed: all fixture timestamps are UTC wall clock
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()
#: Folder of each local application that names none.
_LOCAL: dict[str, str] = {}


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers (``addPyFile``), once per
    application: functions that run there are imported from it. On a
    cluster this is what makes executors see the code; locally it keeps
    workers independent of the driver's working directory."""
    import hashlib
    import io
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in sorted(os.walk(root)):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    data = buf.getvalue()
    base = tempfile.mkdtemp(prefix="relayplan-py-")   # on the driver; Spark serves it to executors
    path = os.path.join(base, f"relayplan-{hashlib.sha1(data).hexdigest()[:12]}.zip")
    with open(path, "wb") as fh:
        fh.write(data)
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, in whatever store the path names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir``. Only when it is unset (local runs and
    tests) a private folder is made, one per application.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        d = _LOCAL.get(spark.sparkContext.applicationId)
        if d is None:
            d = _LOCAL[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="relayplan-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


#: Paths handed out by ``scratch_path``, by application.
_SCRATCH: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, unique per call."""
    base = shared_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


#: Whether the files of an execution's exchanges go when it ends. Else they stay until
#: the driver collects the garbage of its plan, and those of all steps add up on disk.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def releasing(spark: SparkSession):
    """Executions in this block leave no exchange files behind."""
    was = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(RELEASE)
        else:
            spark.conf.set(RELEASE, was)


def stored(df, *replaced):
    """``df`` written once to the shared folder and read from there; its exchanges
    are released. ``replaced``: stored tables that nothing reads any more."""
    spark = df.sparkSession
    path = scratch_path(spark, "stored")
    with releasing(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_path = path
    discard(*replaced)
    return out


def discard(*tables) -> None:
    """Delete tables that ``stored`` wrote; others are left alone."""
    for df in tables:
        path = getattr(df, "stored_path", None)
        if path is not None:
            p = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def clean_scratch(spark: SparkSession) -> int:
    """Delete what this application wrote under ``scratch_path`` (stream
    outputs, checkpoints, stored tables). Call it when results are written;
    DataFrames that read those folders end with it. Returns how many existed."""
    paths = _SCRATCH.pop(spark.sparkContext.applicationId, [])
    conf = spark._jsc.hadoopConfiguration()
    n = 0
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        n += bool(p.getFileSystem(conf).delete(p, True))
    return n


#: Bytes of parquet input for which an exchange gets one more partition. Rows of
#: the derived tables are long texts: a task then holds some ten times as much.
EXCHANGE_INPUT = 4 << 20
INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
#: Shuffled bytes up to which adaptive execution puts partitions together. Keys and
#: paths shrink to a tenth in an exchange, and a task sorts and aggregates them
#: several times over: 64 MB, Spark's default, are over 1 GB of its memory.
EXCHANGE_OUTPUT = 8 << 20
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
#: What ``size_exchanges`` set, by application.
_SIZED: dict[str, str] = {}


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a file or folder; 0 if there is none."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def size_exchanges(spark: SparkSession, input_bytes: int) -> int:
    """Let exchanges start with partitions in step with the input, so that a task
    sorts, joins and aggregates as much of a large input as of a small one;
    adaptive execution puts small ones together, up to ``EXCHANGE_OUTPUT``. What the
    session has chosen itself stays. Returns the number of partitions."""
    app = spark.sparkContext.applicationId
    if spark.conf.get(ADVISORY, None) in (None, ""):
        spark.conf.set(ADVISORY, str(EXCHANGE_OUTPUT))
    chosen = spark.conf.get(INITIAL, None)
    if chosen and chosen != _SIZED.get(app):
        return exchange_partitions(spark)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = -(-input_bytes // EXCHANGE_INPUT)
    if wanted > least:
        _SIZED[app] = str(wanted)
        spark.conf.set(INITIAL, _SIZED[app])
    elif chosen:
        spark.conf.unset(INITIAL)
    return exchange_partitions(spark)


def exchange_partitions(spark: SparkSession) -> int:
    """Partitions an exchange starts with."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(spark.conf.get(INITIAL, None) or 0))


def size_for_input(spark: SparkSession, input_bytes: int, partition_bytes: int = 256 << 20,
                   shuffle_expansion: float = 0.5) -> dict[str, str]:
    """Partition settings for a run over ``input_bytes`` of parquet.

    - scan splits of ``partition_bytes`` (256 MB): a 100 TB scan is ~400k tasks
    - shuffle partitions sized so the largest exchange (about
      ``shuffle_expansion`` x input after pruning: the inventory join/explode)
      lands near ``partition_bytes`` per reducer before AQE coalescing; small
      exchanges are coalesced to the advisory size by AQE
    - skew: a reducer 5x the median and above 2 x ``partition_bytes`` is split

    Only settings the session does not define are applied; returns them.
    """
    shuffle = max(200, int(input_bytes * shuffle_expansion / partition_bytes))
    wanted = {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * partition_bytes),
    }
    applied = {}
    for k, v in wanted.items():
        if spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)
            applied[k] = v
    return applied
