"""Lake layout, run naming, shared scratch space and single-file writes.

Zones: ``landing/<folder>/event_date=YYYY-MM-DD``,
``silver/<dataset>/run_id=<start>_<end>_<ts>``,
``rejected/<dataset>/run_id=...`` and ``gold/<name>/<version>/split=...``.
"""

from __future__ import annotations

import datetime as dt
import os
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

RUN_TS_FORMAT = "%Y%m%d-%H%M%S"


def run_timestamp(now: dt.datetime | None = None) -> str:
    return (now or dt.datetime.now(dt.timezone.utc)).strftime(RUN_TS_FORMAT)


def make_run_id(start, end, run_ts: str | None = None) -> str:
    """``<start>_<end>_<run_ts>``; open bounds are written ``open``."""
    return f"{start or 'open'}_{end or 'open'}_{run_ts or run_timestamp()}"


def silver_root(lake: str, dataset: str) -> str:
    return f"{lake}/silver/{dataset}"


def silver_dir(lake: str, dataset: str, run_id: str) -> str:
    return f"{lake}/silver/{dataset}/run_id={run_id}"


def rejects_dir(lake: str, dataset: str, run_id: str) -> str:
    return f"{lake}/rejected/{dataset}/run_id={run_id}"


def landing_root(lake: str, folder: str) -> str:
    return f"{lake}/landing/{folder}"


def gold_dir(gold_root: str, version: str) -> str:
    return f"{gold_root}/{version}"


def hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = hadoop_fs(spark, path)
    return bool(fs.exists(p))


def create_once(spark: SparkSession, path: str, text: str) -> None:
    """Create one small text file whole, or raise FileExistsError: of several writers exactly one succeeds.

    Local disks: a hard link to a finished draft.  HDFS: a rename, which never
    replaces a file there.  Object stores: a create without overwrite, where
    the object appears at close and stores with conditional writes refuse a
    second one (others only if it is there when the write begins).
    """
    target, fs = hadoop_fs(spark, path)
    scheme = fs.getUri().getScheme()
    folder, name = path.rsplit("/", 1)
    draft_name = f".{uuid.uuid4().hex}.draft"
    if scheme == "file":
        local = str(target.toUri().getPath()).rsplit("/", 1)[0]
        os.makedirs(local, exist_ok=True)
        with open(f"{local}/{draft_name}", "w", encoding="utf-8") as f:
            f.write(text)
        try:
            os.link(f"{local}/{draft_name}", f"{local}/{name}")
        finally:
            os.unlink(f"{local}/{draft_name}")
        return
    renames = scheme in ("hdfs", "viewfs")
    written = hadoop_fs(spark, f"{folder}/{draft_name}")[0] if renames else target
    if fs.exists(target):
        raise FileExistsError(path)
    try:
        out = fs.create(written, False)
        out.write(bytearray(text, "utf-8"))
        out.close()
    except Py4JJavaError as e:
        if "FileAlreadyExists" in str(e.java_exception):
            raise FileExistsError(path) from e
        raise
    if renames and not fs.rename(written, target):
        fs.delete(written, False)
        raise FileExistsError(path)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Commit one small text file: readers see all of it or nothing, and an existing file is never replaced."""
    create_once(spark, path, text)


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names directly under a folder; none if it is not there."""
    if not path_exists(spark, folder):
        return []
    p, fs = hadoop_fs(spark, folder)
    paths = spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(fs.listStatus(p))
    return [str(x.getName()) for x in paths]


def read_text(spark: SparkSession, path: str) -> str:
    """The text of one file written whole by ``write_text`` (names starting with ``_`` are hidden from Spark's readers)."""
    p, fs = hadoop_fs(spark, path)
    stream = fs.open(p)
    try:
        return str(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def folder_bytes(spark: SparkSession, folder: str) -> int:
    """Size of all files under a folder; 0 if it is not there."""
    p, fs = hadoop_fs(spark, folder)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder this library made (a staged copy whose outputs are committed)."""
    p, fs = hadoop_fs(spark, path)
    fs.delete(p, True)


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder this library made to a path where nothing is."""
    (p, fs), (q, _) = hadoop_fs(spark, source), hadoop_fs(spark, target)
    fs.mkdirs(q.getParent())
    if fs.exists(q) or not fs.rename(p, q):
        raise FileExistsError(target)


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Where the session names none, a local session gets a private folder; any
    other session is refused, as its executors would each see their own disk.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="triplake-ckpt-"))
        d = sc.getCheckpointDir()
    return d.rstrip("/")


def scratch_dir(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh folder under the shared checkpoint root (never machine-local on a cluster)."""
    return f"{checkpoint_root(spark)}/triplake-{name}-{uuid.uuid4().hex[:12]}"


def run_concurrently(*jobs: Callable[[], object]) -> list:
    """Run independent Spark actions from separate driver threads.

    Each action is its own Spark job; submitted together they share the
    executors and overlap their driver-side phases (listing, commit).
    The first failure is raised after all have finished.
    """
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        futures = [pool.submit(j) for j in jobs]
    return [f.result() for f in futures]
