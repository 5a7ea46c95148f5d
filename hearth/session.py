"""Session helpers: a local session for tests/bench, and the shared folder for materialised
tables.

Materialised tables go under the folder the cluster names in ``spark.checkpoint.dir`` (shared
storage every executor can read, so a lost executor never loses a table). A local default is
set only when the session has none, as in tests.
"""

from __future__ import annotations

import contextlib
import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "hearth") -> SparkSession:
    """Local session for tests and the bench (UI off, AQE on, UTC, ANSI as default)."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("HEARTH_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and materialised tables.

    Read from the session (``spark.checkpoint.dir``, else the context's checkpoint dir). When
    neither is set, a local master (tests) gets a temporary folder, registered with
    ``SparkContext.setCheckpointDir`` (``spark.checkpoint.dir`` itself cannot be changed at
    runtime); on a cluster that is an error, because other machines would not see it.
    """
    d = spark.conf.get(CHECKPOINT_CONF, None)
    sc = _context(spark)
    if not d and sc is not None:
        d = sc.getCheckpointDir()
    if not d:
        if sc is None or not re.match(r"local(\[|$)", sc.master or ""):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="hearth-ckpt-")
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def _context(spark: SparkSession):
    """The SparkContext, or None where the session has none (Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions raise on access
        return None


def app_id(spark: SparkSession) -> str:
    """Identifier of the running application (used to scope cached workspaces)."""
    sc = _context(spark)
    return sc.applicationId if sc is not None else spark.conf.get("spark.app.id", "connect")


def new_run_dir(spark: SparkSession, prefix: str = "model") -> str:
    """A fresh sub-folder of the shared folder for one materialisation run."""
    return f"{shared_dir(spark)}/hearth-{prefix}-{uuid.uuid4().hex[:12]}"


def _file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path) of a folder or file, wherever Spark can read it."""
    sc = _context(spark)
    if sc is None:
        return None, None
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()), p


def remove_folder(spark: SparkSession, path: str, root: str | None = None) -> None:
    """Remove a folder that this application wrote under the shared folder, or a part of the table at ``root``."""
    if not path.startswith(shared_dir(spark) + "/hearth-" if root is None else root.rstrip("/") + "/"):
        raise ValueError(f"{path} is not a folder of this library")
    fs, p = _file_system(spark, path)
    if fs is not None:
        fs.delete(p, True)


def trim_driver(spark: SparkSession) -> str:
    """Give memory that the driver JVM's allocator has freed, but holds for later, back to the machine;
    what the JVM says about it, or nothing where it cannot (other JVMs, no SparkContext).

    Compiler threads and the short-lived threads of broadcasts and shuffles leave such memory in up
    to eight arenas a core, which only grow over a session of many plans; heap is not concerned."""
    sc = _context(spark)
    if sc is None:
        return ""
    with contextlib.suppress(Exception):
        java = sc._jvm.java.lang
        # by reflection on the public interface: the server's own class is not open to callers
        call = next(m for m in java.Class.forName("javax.management.MBeanServerConnection").getMethods() if m.getName() == "invoke")
        given = sc._gateway.new_array(java.Object, 4)
        given[0], given[1] = sc._jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        return str(call.invoke(java.management.ManagementFactory.getPlatformMBeanServer(), given)).strip()
    return ""


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file; False if it exists already."""
    fs, p = _file_system(spark, path)
    if fs.exists(p):
        return False
    try:
        out = fs.create(p, False)
    except Exception as e:  # noqa: BLE001 - another writer came first
        if "already exists" in str(e).lower() or "FileAlreadyExists" in str(e):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def read_file(spark: SparkSession, path: str) -> str:
    """Text of a small file."""
    fs, p = _file_system(spark, path)
    got = fs.open(p)
    try:
        return bytes(got.readAllBytes()).decode()
    finally:
        got.close()


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in a folder; none if it does not exist."""
    fs, p = _file_system(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []


def list_files(spark: SparkSession, path: str) -> list[str]:
    """The files at ``path`` (a file, a folder or a pattern), without hidden ones, in order."""
    fs, p = _file_system(spark, path)
    if fs is None:
        raise RuntimeError("files cannot be listed without a SparkContext")
    hidden = lambda f: f.getPath().getName().startswith(("_", "."))
    found, todo = [], list(fs.globStatus(p) or [])
    while todo:
        f = todo.pop()
        if f.isDirectory():
            todo += [x for x in fs.listStatus(f.getPath()) if not hidden(x)]
        else:
            found.append(f.getPath().toString())
    return sorted(found)


def file_state(spark: SparkSession, path: str) -> tuple:
    """Sizes and modification times of a table's files; changes when the table does."""
    fs, p = _file_system(spark, path)
    if fs is None or not fs.exists(p):
        return ()
    files = fs.listStatus(p)
    return tuple(sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in files))
