"""Session construction and shared scratch locations.

Scratch output (round trips, snapshots, upsert generations) always lives
under the folder the session names in ``spark.checkpoint.dir``: on a cluster
that is a shared, durable file system, so a lost executor never takes
intermediate results with it. Only when the setting is absent (tests, a
laptop) do we pick a local folder ourselves, and only for a local master.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import threading
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Get or create a session with AQE on and the UI off."""
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
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a local one is made only for a local master.

    On a cluster a folder of this machine would be invisible to the executors, so an unset setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    context = getattr(spark, "sparkContext", None) if not root else None
    if not root and context is not None:
        root = context.getCheckpointDir()
    if not root:
        if context is None or not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
        context.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused directory under the checkpoint root (made by whoever writes to it)."""
    return f"{checkpoint_root(spark)}/tessera/{name}-{uuid.uuid4().hex[:12]}"


# Open scopes per session and setting: the value before the first, and the values set since.
_scopes: dict[tuple[int, str], tuple[str | None, list[tuple[object, str]]]] = {}
_scopes_lock = threading.Lock()


@contextlib.contextmanager
def scoped_conf(spark: SparkSession, values: dict[str, str]):
    """Set session settings for the actions run inside the block, then restore.

    Blocks may overlap on several threads, ending in any order: a setting goes back to what it was
    before the first of them when the last one ends, and in between has the value of the youngest
    block that is still open.
    """
    me = object()

    def put(key: str, value: str | None) -> None:
        if value is None:
            spark.conf.unset(key)
        elif spark.conf.get(key, None) != value:
            spark.conf.set(key, value)

    with _scopes_lock:
        for key, value in values.items():
            _scopes.setdefault((id(spark), key), (spark.conf.get(key, None), []))[1].append((me, value))
            put(key, value)
    try:
        yield
    finally:
        with _scopes_lock:
            for key in values:
                before, open_ = _scopes[(id(spark), key)]
                open_[:] = [x for x in open_ if x[0] is not me]
                put(key, open_[-1][1] if open_ else before)
                if not open_:
                    del _scopes[(id(spark), key)]


# Joins may broadcast a side only once AQE has measured it: the static
# threshold (a guess from file sizes) is off, the runtime one is on.
RUNTIME_BROADCAST_ONLY = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
}


def run_parallel(fn, items, max_workers: int = 8) -> list:
    """``[fn(x) for x in items]`` on a small driver thread pool, order kept.

    For per-table driver work (listing and footer reads, independent writes):
    Spark runs jobs submitted from several threads concurrently, so many small
    tables share the cluster instead of queueing one after another.
    """
    items = list(items)
    if max_workers <= 1 or len(items) <= 1:
        return [fn(x) for x in items]
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=min(max_workers, len(items))) as pool:
        return list(pool.map(fn, items))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, asked of the path's own (Hadoop) file system."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return bool(hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath))


_shipped: set[str] = set()
_ship_lock = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make ``tessera`` importable by this application's Python workers.

    Python UDFs are pickled by module name, so workers must import the
    package. On a cluster it is shipped at submit time (``--py-files``); for
    local sessions whose workers may not see the driver's import path, the
    package is zipped once per application under the checkpoint folder and
    added with ``addPyFile``.
    """
    try:
        sc = spark.sparkContext
        app = sc.applicationId
    except Exception:  # noqa: BLE001 — remote session: code ships with the client
        return
    with _ship_lock:
        if app in _shipped:
            return
        root = checkpoint_root(spark)
        if "://" in root and not root.startswith("file:"):
            _shipped.add(app)  # a cluster store: rely on --py-files / an installed package
            return
        import hashlib
        import zipfile
        pkg = os.path.dirname(os.path.abspath(__file__))
        files = sorted(os.path.join(d, f) for d, _, fs in os.walk(pkg) for f in fs if f.endswith(".py"))
        digest = hashlib.sha1()
        for f in files:
            with open(f, "rb") as fh:
                digest.update(f.encode() + fh.read())
        local_root = root[len("file:"):] if root.startswith("file:") else root
        target = os.path.join(local_root, "tessera", "pkg", f"tessera-{digest.hexdigest()[:16]}.zip")
        if not os.path.exists(target):
            os.makedirs(os.path.dirname(target), exist_ok=True)
            tmp = f"{target}.{uuid.uuid4().hex[:8]}"
            with zipfile.ZipFile(tmp, "w", zipfile.ZIP_DEFLATED) as z:
                for f in files:
                    z.write(f, os.path.join("tessera", os.path.relpath(f, pkg)))
            os.replace(tmp, target)
        sc.addPyFile(target)
        _shipped.add(app)
