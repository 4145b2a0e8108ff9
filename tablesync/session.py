"""Session defaults and the shared scratch location.

Nothing here changes a setting the caller already chose: the helpers only
fill in values that are unset, so a cluster's own configuration wins.
"""

from __future__ import annotations

import os
import re
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Defaults for a job session.  AQE re-plans joins and coalesces/splits
# partitions from runtime statistics; the skew rule splits a hot join key.
JOB_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.debug.maxToStringFields": "1000",
    "spark.network.timeout": "600s",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def job_session(app_name: str = "tablesync", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session with the job defaults; explicit ``conf`` wins."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**JOB_DEFAULTS, "spark.ui.enabled": "false", **conf}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and staging.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir).
    Only when neither is set on a ``local`` master -- local runs and tests --
    a fresh local folder is created and registered, so later calls agree on
    it; on a cluster an unset folder is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):  # local-cluster is a cluster
            # executors on other machines could not see a local folder
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="tablesync-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    return root


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new, unique folder below the checkpoint root for one run."""
    return os.path.join(checkpoint_root(spark), "tablesync", purpose, uuid.uuid4().hex)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, on whatever file system the path names."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath)


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of ``path`` (empty when it does not exist)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return []
    return [st.getPath().getName() for st in fs.listStatus(hpath) if st.isDirectory()]


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder (recursively) on whatever file system the path names."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(hpath, True)) if fs.exists(hpath) else False


def create_file(spark: SparkSession, path: str) -> bool:
    """Create an empty file unless it is there already (one of several writers wins)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hpath.getParent())
    return bool(fs.createNewFile(hpath))


def age_hours(spark: SparkSession, path: str) -> float:
    """Hours since a file or folder was last changed."""
    import time

    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return time.time() / 3600 - fs.getFileStatus(hpath).getModificationTime() / 3_600_000


_case_lock = threading.Lock()
_case_users: dict[int, tuple[int, str]] = {}  # session -> users inside, value before the first


@contextmanager
def case_sensitive(spark: SparkSession):
    """For the actions inside, names that differ by case are different names
    (merging the schemas of documents would otherwise drop one of two keys).

    Concurrent users of a session share the setting: the first one in sets it, the
    last one out restores it.  Other queries planned meanwhile on this session see it.
    """
    key = "spark.sql.caseSensitive"
    with _case_lock:
        users, before = _case_users.get(id(spark), (0, spark.conf.get(key)))
        _case_users[id(spark)] = (users + 1, before)
        spark.conf.set(key, "true")
    try:
        yield
    finally:
        with _case_lock:
            users, before = _case_users.pop(id(spark))
            if users > 1:
                _case_users[id(spark)] = (users - 1, before)
            else:
                spark.conf.set(key, before)
