"""Session helpers: a local session for tests and benches, and the shared scratch folder.

On a cluster the caller owns the session; nothing here overrides a setting that is already there.
The shared folder is the one the cluster names in ``spark.checkpoint.dir``; a folder of our own is
made only when that setting is missing and the master is local (one process).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, Observation, SparkSession

# Settings the jobs are tuned for. AQE re-plans joins from runtime sizes (broadcast only when the
# measured shuffle output is under Spark's default 10 MB threshold), coalesces small partitions and
# splits skewed ones.
TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when that costs a shuffle after the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
}


def apply_tuning(spark: SparkSession) -> None:
    """Set what TUNING names and the owner of the session has not set."""
    given = dict(spark.sparkContext.getConf().getAll()) if _context(spark) is not None else {}
    for k, v in TUNING.items():
        if k not in given:
            spark.conf.set(k, v)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "mutualis",
                  driver_memory: str = "8g", extra: dict | None = None) -> SparkSession:
    """A local session (tests, bench). UI off; checkpoint folder made under the temp dir."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", driver_memory)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in {**TUNING, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # e.g. a remote (Connect) session has no local SparkContext
        return None


def _is_local(sc) -> bool:
    return sc is not None and sc.master.startswith("local") and not sc.master.startswith("local-cluster")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder from ``spark.checkpoint.dir``.

    Where it is unset, a local master gets a folder of its own (driver and executors are one
    process); any other master, and a remote session, is an error: a machine-local folder would be
    a different one on every executor.
    """
    sc = _context(spark)
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not _is_local(sc):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and all "
                               "executors share (on the command line: --scratch-dir)")
        current = tempfile.mkdtemp(prefix="mutualis-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if sc is not None:
        sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    return current


def app_id(spark: SparkSession) -> str:
    sc = _context(spark)
    return sc.applicationId if sc is not None else spark.conf.get("spark.app.id", "app")


class Scratch:
    """The scratch folders of one scope, and the way to delete them."""

    def __init__(self):
        self.folders: list[str] = []
        self.tables: list[str] = []  # the catalog's names of bucketed folders
        self.broadcasts: list = []   # what was sent to the executors for it
        self.spent: list = []        # the same where no frame that is left asks for it

    def release(self, spark: SparkSession) -> int:
        """Delete this scope's folders; returns how many were there. DataFrames that read them are
        of no use afterwards. A remote session cannot delete files: they stay listed."""
        sc = _context(spark)
        if sc is None:
            return 0
        conf, done = sc._jsc.hadoopConfiguration(), 0
        while self.broadcasts:
            self.broadcasts.pop().unpersist()  # sent again where something still asks for it
        while self.spent:
            self.spent.pop().destroy()  # its file on the driver too
        while self.tables:
            spark.sql(f"DROP TABLE IF EXISTS {self.tables.pop()}")
        while self.folders:
            folder = self.folders.pop()
            _LIVE.discard(folder)
            path = sc._jvm.org.apache.hadoop.fs.Path(folder)
            done += bool(path.getFileSystem(conf).delete(path, True))
        return done


_LIVE: set[str] = set()  # folders made by this process and not deleted
_LOOSE = Scratch()       # folders made outside any scope
# Open scopes of the running thread or task, innermost last.
_OPEN: ContextVar[tuple[Scratch, ...]] = ContextVar("mutualis_scratch", default=())


def current_scope() -> Scratch:
    """The innermost open scope of this thread or task, else the one of folders outside any scope.
    Taken before a ``scratch_scope`` block, it keeps what the block hands out."""
    return (_OPEN.get() or (_LOOSE,))[-1]


def scratch_path(spark: SparkSession, name: str, scope: Scratch | None = None) -> str:
    """A fresh path below the shared checkpoint folder (never reused), in the given scope, else in
    the current one."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/scratch-{uuid.uuid4().hex[:12]}"
    (current_scope() if scope is None else scope).folders.append(folder)
    _LIVE.add(folder)
    return f"{folder}/{name}"


def is_live(path: str) -> bool:
    """Whether a path from ``scratch_path`` has not been released."""
    return path.rpartition("/")[0] in _LIVE


def drop_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders made outside any scope; returns how many were there."""
    return _LOOSE.release(spark)


@contextmanager
def scratch_scope(spark: SparkSession):
    """Intermediates that this thread or task writes inside the block (outside inner blocks) are
    deleted when it ends; what others write, and outputs, stay."""
    own = Scratch()
    _OPEN.set((*_OPEN.get(), own))
    try:
        yield own
    finally:
        _OPEN.set(tuple(s for s in _OPEN.get() if s is not own))
        own.release(spark)


def materialize(df: DataFrame, name: str, metrics: dict | None = None, scope: Scratch | None = None):
    """Write ``df`` once as parquet below the shared checkpoint folder and read it back.

    Used for an intermediate that several later steps read: it is computed once, lineage is cut
    (a lost executor re-reads files, nothing upstream re-runs), and the planner sees real file
    sizes for its join choices. ``metrics`` (name → aggregate column) are observed during the same
    write (``DataFrame.observe``), with no extra job; then ``(df, values)`` is returned.
    """
    path = scratch_path(df.sparkSession, name, scope)
    obs = None
    if metrics:
        obs = Observation(name)
        df = df.observe(obs, *[c.alias(k) for k, c in metrics.items()])
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)  # known schema: no footer-reading job
    return (out, obs.get) if obs is not None else out


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Jobs inside the block delete their shuffle files when they end, not when the driver collects garbage: for frames
    that run once, as those that ``materialize`` writes."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def write_buckets(df: DataFrame, name: str, keys: list[str], scope: Scratch | None = None,
                  rest: list[DataFrame] | tuple = ()) -> DataFrame:
    """Like ``materialize``, dealt to ``spark.sql.shuffle.partitions`` buckets by ``keys`` and sorted in
    each, so that a join on the keys reads them without an exchange. Buckets are known to the catalog
    only: the folder is an external table until its scope is released. ``rest``: rows that jobs of their own add."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, name, scope)
    scope = current_scope() if scope is None else scope
    table = f"mutualis_{name}_{uuid.uuid4().hex[:12]}"
    for some in (df, *rest):
        some.repartition(n, *keys).write.mode("append").bucketBy(n, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
    scope.tables.append(table)
    return spark.table(table)


def size_setting(spark: SparkSession, key: str) -> int:
    """A size in bytes from the session's settings (``10MB``, ``64k``, ``-1``)."""
    text = spark.conf.get(key).strip().lower().removesuffix("b")
    unit = {"k": 10, "m": 20, "g": 30, "t": 40}.get(text[-1:])
    return int(text[:-1]) << unit if unit else int(text)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
