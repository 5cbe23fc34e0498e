"""Session construction and the shared scratch folder.

``DEFAULT_CONF`` holds what every session of this library has: the UTC time zone (timestamps
parsed from text are UTC instants, as the source data is UTC), AQE with its sizes, and plan
building without call-site capture. A local session also gets driver memory and a warehouse
folder of its own. What belongs to one write (such as dynamic partition overwrite) is set there.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # runtime (measured) size limit under which AQE turns a shuffle join into a broadcast
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.files.maxPartitionBytes": "128MB",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.ui.enabled": "false",
    # PySpark otherwise captures the Python call site of every Column function (stack
    # walk + a conf lookup over py4j) for error messages; with plans built from hundreds
    # of expressions that doubles the driver's plan-construction time
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


#: Bytes of input for each initial shuffle partition, when the input size is known.
PARTITION_BYTES = 128 << 20


def shuffle_partitions_for(input_bytes: int) -> int:
    """Initial shuffle partitions for an input of this size. AQE merges small partitions but
    does not split those of an aggregate, so the initial number must follow the input."""
    return max(200, -(-input_bytes // PARTITION_BYTES))


def build_session(
    app: str = "ecoflux",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    input_bytes: int | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    ``master`` is only set when given: on a cluster the launcher decides it, and also the
    number of shuffle partitions unless ``input_bytes`` (of the largest input) is given.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor; keep catalog folders out of cwd
        conf["spark.driver.memory"] = "16g"
        conf["spark.sql.warehouse.dir"] = _local_folder("ecoflux-warehouse-")
    else:
        # coalesce toward the advisory size; the default (parallelism first) ignores it and
        # keeps ~1 MB partitions, i.e. many tiny tasks on a busy cluster
        conf["spark.sql.adaptive.coalescePartitions.parallelismFirst"] = "false"
    if input_bytes:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions_for(input_bytes))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k in ("spark.sql.session.timeZone",):
        spark.conf.set(k, conf[k])
    return spark


def _local_folder(prefix: str) -> str:
    """A temporary folder of a local-mode session, removed when the process ends."""
    path = tempfile.mkdtemp(prefix=prefix)
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names storage every executor can reach, and it is used
    as given. Only a local-mode session (tests, a laptop) with the setting unset gets a
    fresh local folder; a cluster session without it is an error, because a folder on
    the driver's disk is not visible to executors and does not survive losing them.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a shared folder (HDFS, object store) "
            "that every executor can reach"
        )
    local = _local_folder("ecoflux-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


#: Scratch folders that this process has named and not yet cleared.
_scratch: list[str] = []


def scratch_dir(spark: SparkSession, name: str = "scratch") -> str:
    """A new, unique folder below the shared checkpoint root for written intermediates. It
    stays until :func:`clear_scratch` or the end of the process, as lazy results read it."""
    root = checkpoint_root(spark).rstrip("/")
    _scratch.append(f"{root}/ecoflux-{name}-{uuid.uuid4().hex[:12]}")
    return _scratch[-1]


def clear_scratch(spark: SparkSession) -> int:
    """Remove the scratch folders of this process; frames that read them must be done with."""
    n = len(_scratch)
    while _scratch:
        at = spark._jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return n


@atexit.register
def _clear_at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.sparkContext._jsc is not None:
        clear_scratch(spark)


def written(df: DataFrame, name: str = "written") -> DataFrame:
    """Write ``df`` to a new scratch folder and read it back: cuts the lineage, and joins see
    its real size."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
