"""Session helpers: building a session, the checkpoint folder, checked broadcasts."""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Upper bound, in bytes, for a side we hand to F.broadcast() after measuring it.
BROADCAST_LIMIT_CONF = "linkstats.broadcast.maxBytes"
DEFAULT_BROADCAST_LIMIT = 64 * 1024 * 1024


def build_session(master: str | None = None, app: str = "linkstats",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """A session with AQE and skew handling on and the web UI off."""
    master = master or os.environ.get("LINKSTATS_MASTER")
    b = SparkSession.builder.appName(app)
    if master:  # else the submission's own master holds
        b = b.master(master)
    b = (b
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.

    On a cluster the folder must come from ``spark.checkpoint.dir`` (a shared file
    system). Only a local-mode session without one gets a scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running iterative jobs")
    path = tempfile.mkdtemp(prefix="linkstats-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


class Scratch:
    """The written tables of one scope, deleted when it ends but for the kept ones."""

    def __init__(self) -> None:
        self.paths: list[str] = []

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written as a table that outlives this scope (not the scopes around it)."""
        path = scratch_path(df.sparkSession, name)
        df.write.mode("overwrite").parquet(path)
        self.paths.remove(path)
        return df.sparkSession.read.parquet(path)


_SCOPES: list[Scratch] = []


def _hadoop_path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _hadoop_path(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder that this library wrote, through the file system it was written with."""
    p, fs = _hadoop_path(spark, path)
    fs.delete(p, True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, sorted."""
    p, fs = _hadoop_path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def move_path(spark: SparkSession, path: str, to: str) -> None:
    p, fs = _hadoop_path(spark, path)
    if not fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"could not move {path} to {to}")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name for intermediate data under the shared checkpoint folder."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    for scope in _SCOPES:
        scope.paths.append(path)
    return path


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[Scratch]:
    """Deletes the intermediate tables written inside when it ends (C1): for jobs whose outputs
    are written, too, before that, or kept by ``Scratch.keep``. Other frames built inside are
    not readable afterwards. Scopes nest: the disk of a job falls back step by step."""
    scope = Scratch()
    _SCOPES.append(scope)
    try:
        yield scope
    finally:
        _SCOPES.remove(scope)
        for path in scope.paths:
            delete_path(spark, path)


class Steps:
    """The written steps of one job, so that a job that failed goes on behind its last one.

    A step is a Parquet table under ``folder/key``; it is done when Spark has committed it (its
    ``_SUCCESS`` file). ``key`` names the input and the options: other ones are another job.
    """

    def __init__(self, spark: SparkSession, folder: str, key: str):
        self.spark, self.path = spark, f"{folder.rstrip('/')}/{hashlib.sha256(key.encode()).hexdigest()[:24]}"
        self.done: list[str] = []

    def table(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The step's table, built only where no earlier run finished it."""
        path = f"{self.path}/{name}"
        if path_exists(self.spark, f"{path}/_SUCCESS"):
            self.done.append(name)
        else:
            build().write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def forget(self) -> None:
        delete_path(self.spark, self.path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table under the checkpoint folder and read it back.

    Cuts lineage like ``checkpoint()`` but stays columnar: later reads prune columns,
    push filters and give the planner real file sizes. The folder is the shared one the
    session names in ``spark.checkpoint.dir``, so the table survives lost executors.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def broadcast_limit(spark: SparkSession) -> int:
    return int(spark.conf.get(BROADCAST_LIMIT_CONF, str(DEFAULT_BROADCAST_LIMIT)))


def measured_bytes(df: DataFrame) -> int:
    """Upper bound of the payload of ``df``: string bytes plus 16 bytes per value; an array of
    numbers takes 8 more for each element.

    One aggregate action; used to decide a broadcast on an exact, not estimated, size.
    """
    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType.simpleString()
        if t == "string":
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)) + F.lit(16))
        elif t.startswith("array<string"):
            parts.append(F.coalesce(F.aggregate(c, F.lit(0).cast("long"),
                                                lambda acc, x: acc + F.octet_length(x) + 16), F.lit(0)) + 16)
        elif t.startswith("array<"):
            parts.append(F.lit(16) + F.lit(8) * F.coalesce(F.size(c), F.lit(0)).cast("long"))
        else:
            parts.append(F.lit(16))
    row_size = parts[0]
    for p in parts[1:]:
        row_size = row_size + p
    return int(df.agg(F.coalesce(F.sum(row_size), F.lit(0))).first()[0])


def checked_broadcast(df: DataFrame, size_bytes: int | None = None) -> DataFrame:
    """``F.broadcast(df)`` when its measured size is under the limit, else ``df`` as is
    (the join then shuffles, with AQE skew handling)."""
    spark = df.sparkSession
    size = measured_bytes(df) if size_bytes is None else size_bytes
    return F.broadcast(df) if size <= broadcast_limit(spark) else df


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives the executors' Python workers this package, as ``--py-files`` would: Spark
    serves the archive from the driver. Once for each application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="linkstats-code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(archive))
    _SHIPPED.add(sc.applicationId)


def map_arrow(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` with this package in the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)
