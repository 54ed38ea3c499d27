"""Written intermediate tables.

A result that several later jobs read is written once as Parquet in the shared
folder the cluster names in ``spark.checkpoint.dir`` and read back from there.
That cuts the lineage, survives the loss of any executor, keeps column pruning
and filter pushdown for the later reads, and gives Catalyst a measured size to
choose join strategies by.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextvars import ContextVar, copy_context

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}
# (application, folder) of folders that all machines of a cluster share.
_proven: set[tuple[str, str]] = set()
# The scopes open in this thread or context, outermost first.
_scopes: ContextVar[tuple["Scope", ...]] = ContextVar("scopes", default=())


def shared_root(spark: SparkSession) -> str:
    """The folder for staged tables: the cluster's setting, else its warehouse; in local mode any folder will do."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    app = spark.sparkContext.applicationId
    if not _one_process(spark):
        folder = folder or spark.conf.get("spark.sql.warehouse.dir")
        if (app, folder) not in _proven:
            if _own_disk(spark, folder) and not _seen_by_all(spark, folder):
                raise ValueError(
                    f"staged tables would go to {folder}, which each machine reads on its own disk; set "
                    "spark.checkpoint.dir to a folder that the driver and every executor share"
                )
            _proven.add((app, folder))
    if folder:
        return folder.rstrip("/")
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="loamline-stage-")
    return _local_roots[app]


def _one_process(spark: SparkSession) -> bool:
    """Whether tasks run within the driver; ``local-cluster`` has executors with folders of their own."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def _own_disk(spark: SparkSession, folder: str) -> bool:
    """Whether a folder is a local path that nobody declared to be a network mount."""
    if spark.conf.get("spark.loamline.sharedMount", "false") == "true":
        return False
    if "://" not in folder and not folder.startswith("file:"):
        folder = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    return folder.startswith("file:")


def _seen_by_all(spark: SparkSession, folder: str) -> bool:
    """Whether files that tasks write below a folder reach the driver's listing and other tasks, tried out.

    A mount looks like a local path, so only a try tells them apart. There are several tasks for each core, so that
    every executor at hand writes and reads.
    """
    tasks = 4 * spark.sparkContext.defaultParallelism
    path = f"{folder.rstrip('/')}/loamline/{spark.sparkContext.applicationId}/probe-{uuid.uuid4().hex[:12]}"
    try:
        spark.range(0, tasks, 1, tasks).write.parquet(path)
        return spark.read.schema("id bigint").parquet(path).count() == tasks
    finally:
        _delete(spark, path)


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh, unused path below the shared folder, owned by the scopes open in this context."""
    app = spark.sparkContext.applicationId
    path = f"{shared_root(spark)}/loamline/{app}/{label}-{uuid.uuid4().hex[:12]}"
    for scope in _scopes.get():
        scope.paths.append(path)
    return path


def stage(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once and return a frame that reads the written table."""
    path = new_path(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def together(*tasks):
    """Run independent functions at once, so that their jobs share the cluster; results in order.

    Each runs in a copy of the caller's context: what they stage belongs to the caller's scopes.
    """
    with ThreadPoolExecutor(len(tasks)) as pool:
        return [f.result() for f in [pool.submit(copy_context().run, t) for t in tasks]]


class Scope:
    """Collects the tables staged while it is open, so that they can be dropped together.

    Scopes belong to the context that opened them: runs in other threads have their own. A scope
    left by an exception drops its tables. Tables it shares with other scopes (:func:`share`) go with the last of
    them.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []
        self.shared: list["_Shared"] = []

    def __enter__(self) -> "Scope":
        self._token = _scopes.set((*_scopes.get(), self))
        return self

    def __exit__(self, kind, *_) -> None:
        _scopes.reset(self._token)
        if kind is not None:
            self.drop()

    def drop(self) -> int:
        """Delete the tables; frames that read them become unusable. Returns their number."""
        gone = 0
        for path in self.paths:
            gone += _delete(self.spark, path)
        self.paths.clear()
        for table in self.shared:
            table.release(self)
        self.shared.clear()
        return gone


class _Shared:
    """A table made for several scopes, with all that was staged to make it."""

    def __init__(self, key: tuple, own: Scope, path: str):
        self.key, self.own, self.path = key, own, path
        self.size = _size(own.spark, path)
        self.holders: set[Scope | None] = set()

    def whole(self) -> bool:
        return _size(self.own.spark, self.path) == self.size

    def release(self, scope: Scope) -> None:
        with _locks[self.key]:
            self.holders.discard(scope)
            if not self.holders:
                self.own.drop()
                if _shared.get(self.key) is self:
                    del _shared[self.key]


_shared: dict[tuple, _Shared] = {}
_locks: dict[tuple, threading.Lock] = {}


def share(spark: SparkSession, label: str, of: str, make: Callable[[], str]) -> str:
    """The path of the table that ``make`` stages, made once per application and ``of`` and used by all who ask.

    It is held by every scope open where it is asked for and deleted with the last of them, so nobody who still
    reads it loses it because whoever asked first is done. Without an open scope it stays. A table whose files
    have been deleted is made again.
    """
    key = (spark.sparkContext.applicationId, of, label)
    with _locks.setdefault(key, threading.Lock()):
        table = _shared.get(key)
        if table is None or not table.whole():
            own = Scope(spark)
            token = _scopes.set((own,))  # what is staged meanwhile is the table's, not the first caller's
            try:
                table = _shared[key] = _Shared(key, own, make())
            except BaseException:
                own.drop()
                raise
            finally:
                _scopes.reset(token)
        for scope in _scopes.get() or (None,):
            if scope not in table.holders:
                table.holders.add(scope)
                if scope is not None:
                    scope.shared.append(table)
        return table.path


def _size(spark: SparkSession, folder: str) -> tuple[int, int]:
    """(files, bytes) below a folder."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return 0, 0
    found = fs.getContentSummary(path)
    return found.getFileCount(), found.getLength()


def drop_staged(spark: SparkSession) -> bool:
    """Delete every table this application staged."""
    return _delete(spark, f"{shared_root(spark)}/loamline/{spark.sparkContext.applicationId}")


def _delete(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(path, True))
