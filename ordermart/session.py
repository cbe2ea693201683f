"""Session construction, scratch location and small filesystem helpers."""

from __future__ import annotations

import hashlib
import os
import tempfile
import threading

from pyspark.sql import SparkSession

# Settings the library relies on.  Shuffle partition count is left to the
# deployment (thousands on a large cluster; AQE coalesces small ones).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


# Serialises the writes of shared intermediate tables when queries are built from several
# threads of one driver (each table is written once; later callers reuse it).
MATERIALIZE_LOCK = threading.RLock()


def build_session(master: str | None = None, app_name: str = "ordermart",
                  shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the run-time settings every job depends on (safe on an existing session)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def own_session(spark: SparkSession) -> SparkSession:
    """A session with the same settings, tables and context, whose settings can be changed apart."""
    return SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the cluster's ``spark.checkpoint.dir``.

    Only when the session names none (local tests) a private folder is created and
    registered as the checkpoint directory.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="ordermart-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    return "/".join([scratch_root(spark), "ordermart", *parts])


def _code_version() -> str:
    """Content hash of the package source: a code change never reuses an old table."""
    h = hashlib.sha1()
    pkg = os.path.dirname(os.path.abspath(__file__))
    for dirpath, dirnames, filenames in sorted(os.walk(pkg)):
        dirnames.sort()
        for name in sorted(filenames):
            if name.endswith(".py"):
                with open(os.path.join(dirpath, name), "rb") as f:
                    h.update(name.encode())
                    h.update(f.read())
    return h.hexdigest()[:12]


CODE_VERSION = _code_version()


def fingerprint(*items) -> str:
    """Short stable key for a cache folder (input location + parameters + code version)."""
    h = hashlib.sha1()
    h.update(CODE_VERSION.encode())
    for item in items:
        h.update(repr(item).encode())
        h.update(b"\0")
    return h.hexdigest()[:16]


def input_signature(path: str, spark: SparkSession):
    """Path, and name, size and time of every file under it (through Hadoop's file systems, so on any
    store): an input that changes gets a new cache key."""
    fs, jpath = _fs(spark, path)
    if not fs.exists(jpath):
        return (path,)
    files = fs.listFiles(jpath, True)
    found = []
    while files.hasNext():
        st = files.next()
        found.append((st.getPath().toString(), st.getLen(), st.getModificationTime()))
    return (path, tuple(sorted(found)))


# --- Hadoop filesystem access (works for file:, hdfs:, s3a: ... alike) ---------

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return bool(fs.exists(jpath))


def committed(spark: SparkSession, path: str) -> bool:
    """True when a Spark write to ``path`` finished (its _SUCCESS marker exists)."""
    return path_exists(spark, path.rstrip("/") + "/_SUCCESS")


def has_files(spark: SparkSession, path: str) -> bool:
    """True if data files lie under ``path`` (with or without a _SUCCESS marker)."""
    fs, jpath = _fs(spark, path)
    if not fs.exists(jpath):
        return False
    files = fs.listFiles(jpath, True)
    while files.hasNext():
        parts = files.next().getPath().toString()[len(fs.getFileStatus(jpath).getPath().toString()):].split("/")
        if not any(p.startswith(("_", ".")) for p in parts if p):
            return True
    return False


def delete_path(spark: SparkSession, path: str) -> None:
    fs, jpath = _fs(spark, path)
    if fs.exists(jpath):
        fs.delete(jpath, True)


def input_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under ``path`` (Hadoop content summary: no data is read)."""
    fs, jpath = _fs(spark, path)
    return int(fs.getContentSummary(jpath).getLength()) if fs.exists(jpath) else 0


def suggest_shuffle_partitions(total_bytes: int, per_partition: int = 128 << 20, shrink: float = 3.0,
                               minimum: int = 8, maximum: int = 200_000) -> int:
    """Shuffle partitions so one partition holds ~``per_partition`` bytes of shuffled rows.

    ``shrink`` is the expected ratio of input bytes (e.g. JSON text) to shuffled binary rows.
    """
    want = -(-int(total_bytes / shrink) // per_partition)
    return max(minimum, min(maximum, want))


def size_shuffles_for(spark: SparkSession, *paths: str, **kw) -> int:
    """Raise (never lower) ``spark.sql.shuffle.partitions`` to fit the given inputs; AQE then
    coalesces the small ones.  Returns the setting in force."""
    current = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    wanted = suggest_shuffle_partitions(sum(input_bytes(spark, p) for p in paths), **kw)
    if wanted > current:
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
        return wanted
    return current
