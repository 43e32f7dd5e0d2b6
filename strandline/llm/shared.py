"""Shared-folder scratch space and file access used by several operators."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTING = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is read from the session; only where the setting is absent (a local
    session in tests) a fresh folder is made and recorded in the session.
    """
    root = spark.conf.get(SETTING, None)
    if not root:
        root = "file://" + tempfile.mkdtemp(prefix="strandline-")
        spark.conf.set(SETTING, root)
    return root.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_root(spark)}/strandline/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage durably."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch path through Hadoop's file system API."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def open_fs(uri: str):
    """(file system, path) of a URI for use in Python workers."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def read_table_files(uri: str):
    """A pyarrow table of the Parquet files of a folder, read in a worker."""
    import pyarrow.dataset as ds

    filesystem, path = open_fs(uri)
    return ds.dataset(path, filesystem=filesystem, format="parquet", exclude_invalid_files=False).to_table()


_HELD: dict = {}


def forget() -> None:
    """Give back what a Python worker keeps; its memory goes to the system, not to the allocators' reserves."""
    import ctypes

    _HELD.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def held(key: tuple, make):
    """What a Python worker keeps between tasks: one thing at a time, so that stages of different operators don't add up."""
    if key not in _HELD:
        forget()
        _HELD[key] = make()
    return _HELD[key]


def _is_scan(plan) -> bool:
    """Whether a logical plan only filters and projects one scan of Parquet files, alike at every run."""
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        if not plan.deterministic():
            return False
        plan = plan.children().head()
    return plan.nodeName() == "LogicalRelation"


def with_rows(docs: DataFrame, span: int) -> DataFrame:
    """``docs`` plus __row, a row's number in its file, and __split, the same for ``span`` rows that follow each other.

    Neither depends on how a scan cuts the files, so two scans agree. Rows that are not
    just read from Parquet files are written first.
    """
    keys = [F.col("_metadata.row_index").alias("__row"), F.expr(f"xxhash64(_metadata.file_path, _metadata.row_index div {span})").alias("__split")]
    if _is_scan(docs._jdf.queryExecution().analyzed()):
        try:
            keyed = docs.select("*", *keys)
            keyed.schema  # noqa: B018  the analysis
            return keyed
        except AnalysisException:  # files without row numbers
            pass
    return materialize(docs, "row-input").select("*", *keys)


def write_side(rows: DataFrame, name: str) -> str:
    """One folder for each split; a split's rows are bounded by the split."""
    uri = scratch(rows.sparkSession, name)
    rows.repartition("__split").write.partitionBy("__split").parquet(uri)
    return uri


def read_side(uri: str, split: int) -> pa.Table | None:
    """A split's side rows, or None."""
    import pyarrow.dataset as ds
    from pyarrow import fs

    filesystem, path = open_fs(f"{uri}/__split={split}")
    if filesystem.get_file_info(path).type == fs.FileType.NotFound:
        return None
    return ds.dataset(path, filesystem=filesystem, format="parquet").to_table()


def by_split(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Batches cut where the split changes."""
    for batch in batches:
        keys, at = batch.column(column).to_pylist(), 0
        for k in range(1, len(keys) + 1):
            if k == len(keys) or keys[k] != keys[at]:
                yield keys[at], batch.slice(at, k - at)
                at = k
