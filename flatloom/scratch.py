"""Written intermediate tables in the folder that every executor can reach."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_local_roots: dict[str, str] = {}
# The paths that the innermost `stages` block will remove.
_owned: ContextVar[list[str] | None] = ContextVar("owned", default=None)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by the session; a temporary one only in local mode.

    A cluster has to set ``spark.checkpoint.dir``, since a folder on the driver's
    machine is out of the executors' reach. What it names is taken as shared: a
    ``file:`` path can be a folder that all machines mount.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_roots:
        root = tempfile.mkdtemp(prefix="flatloom-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        _local_roots[context.applicationId] = root
    return _local_roots[context.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    """A path that no other call has been given; an enclosing ``stages`` block owns it."""
    path = f"{scratch_root(spark)}/{spark.sparkContext.applicationId}-{name}-{uuid.uuid4().hex}"
    owned = _owned.get()
    if owned is not None:
        owned.append(path)
    return path


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete written tables, folders and all; what is not there is passed over."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs whose DataFrames are no longer referenced.

    It does so when the driver collects its garbage, which on a large heap may be long after
    the files have become useless; between the steps of a job with large shuffles that is
    worth asking for. Asked twice, as what the first collection frees still holds other files.
    """
    for pause in (0.5, 0.0):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(pause)


@contextmanager
def stages(spark: SparkSession) -> Iterator[None]:
    """Remove every scratch table that is written inside the block when it ends.

    Results that read such tables must have been consumed by then. Outside of any block
    scratch tables stay, so that lazy results can be read at any time.
    """
    token = _owned.set([])
    try:
        yield
    finally:
        remove(spark, *_owned.get())
        _owned.reset(token)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet and return the written table.

    This cuts the lineage, fixes values that would differ if computed again, and
    gives Catalyst the true size of the result for its broadcast decision.
    """
    return df.sparkSession.read.schema(df.schema).parquet(write_new(df, name))


def write_new(df: DataFrame, name: str) -> str:
    """Write ``df`` as Parquet to a path of its own and return the path."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return path


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows, in one partition, made without Python workers."""
    return spark.range(0, 0, 1, 1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
