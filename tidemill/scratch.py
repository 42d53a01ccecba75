"""Intermediate tables in the folder that the driver and all executors share.

The folder is the session's ``spark.checkpoint.dir``.  A lost executor loses nothing that was
written here, so these tables are where long lineages are cut.  They stay as long as a result may be
read from them; whoever has written a result elsewhere may ``release`` what was made for it.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

CONF = "spark.checkpoint.dir"
_own: list[str] = []
#: What each thread has written; ``release`` in one never touches another's tables.
_scopes: dict[int, list[str]] = {}


def _made() -> list[str]:
    return _scopes.setdefault(threading.get_ident(), [])


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session; a temporary one is made only on a local master."""
    path = spark.conf.get(CONF, None) or next(iter(_own), None)
    if path:
        return path.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError(f"{CONF} must name a folder that all executors share")
    _own.append(tempfile.mkdtemp(prefix="tidemill-"))
    spark.sparkContext.setCheckpointDir(_own[0])
    return _own[0]


def place(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder, which goes when written tables go."""
    path = f"{shared_dir(spark)}/tidemill-{name}-{uuid.uuid4().hex}"
    _made().append(path)
    return path


def written(df: DataFrame, name: str = "t", compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and return the table read back; by the session's compression, if none is named."""
    spark = df.sparkSession
    path = place(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def mark() -> int:
    """A point in this thread's time for ``release``."""
    return len(_made())


def _delete(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def release(spark: SparkSession, since: int, keep: int = 1) -> None:
    """Delete the tables that this thread wrote after ``since`` but the last ``keep``; nothing may read them any more."""
    made = _made()
    gone = made[since : len(made) - keep]
    for path in gone:
        _delete(spark, path)
    del made[since : since + len(gone)]


def end(spark: SparkSession) -> None:
    """Delete the tables of all threads, on any store; call it before the session is stopped, when nothing runs."""
    for made in list(_scopes.values()):
        while made:
            _delete(spark, made.pop())


@atexit.register
def _clean() -> None:
    """Nothing reads these tables when the process ends; on other stores than the local one ``end`` must have been called."""
    for path in (*_own, *(p for made in _scopes.values() for p in made)):
        if path.startswith(("/", "file:")):
            shutil.rmtree(path.removeprefix("file://").removeprefix("file:"), ignore_errors=True)
