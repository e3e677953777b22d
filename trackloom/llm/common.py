"""What the operators of this subpackage share: scratch tables in the shared folder, and checked column access."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Bytes of an Arrow batch between Spark and Python: what bounds a batch of long texts.
BATCH_BYTES = 4 << 20
_scopes: list[list] = []


def scratch_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Only a local master may do without it (tests), and gets a folder of its own; on a cluster that would be a folder of each machine."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="trackloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def bound_batches(spark: SparkSession) -> None:
    """Bounds Arrow batches by bytes, not by rows alone; a smaller bound that is set already stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    with contextlib.suppress(ValueError):
        if 0 < int(spark.conf.get(key)) <= BATCH_BYTES:
            return
    spark.conf.set(key, str(BATCH_BYTES))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table into the shared folder and read it back: lineage ends there, and a lost executor costs no rerun of what came before."""
    spark = df.sparkSession
    bound_batches(spark)
    path = f"{scratch_dir(spark)}/trackloom/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._trackloom_path = path
    for scope in _scopes[-1:]:
        scope.append(out)
    return out


def discard(df: DataFrame) -> None:
    """Delete a table that :func:`materialize` wrote, once nothing reads it any more."""
    spark, path = df.sparkSession, getattr(df, "_trackloom_path", None)
    if path:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def share(spark: SparkSession, value):
    """A broadcast of a value whose size its maker bounds; a :func:`scratch` scope destroys it."""
    out = spark.sparkContext.broadcast(value)
    for scope in _scopes[-1:]:
        scope.append(out)
    return out


@contextlib.contextmanager
def scratch() -> Iterator[None]:
    """Deletes the scratch tables and broadcasts made inside once it ends, when the caller has written what it needs."""
    _scopes.append([])
    try:
        yield
    finally:
        for x in _scopes.pop():
            discard(x) if isinstance(x, DataFrame) else x.destroy()


def release() -> None:
    """Gives memory that a task no longer uses back to the system; Python workers live on and the next task may need little."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def tidy(run: Callable) -> Callable:
    """A function of Arrow batches that releases memory when its task ends."""

    @functools.wraps(run)
    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return tidied


def by_group(rows: DataFrame, keys: list[str], order: str, function: Callable[[tuple, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``function(key, rows)`` of every group, whose rows come sorted by ``order``: as applyInArrow, but groups stream through a task in the order of their keys, so that thousands of small ones cost little. The caller bounds a group's size."""
    rows = rows.repartition(*keys).sortWithinPartitions(*keys, order)

    def run(batches):
        waiting: list = []

        def done(parts):
            t = pa.Table.from_batches(parts).combine_chunks()
            at = [t.column(k).to_numpy() for k in keys]
            cuts = [0, *(np.flatnonzero(functools.reduce(np.logical_or, [a[1:] != a[:-1] for a in at])) + 1).tolist(), t.num_rows]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                yield from function(tuple(a[lo].item() for a in at), t.slice(lo, hi - lo)).to_batches()

        for batch in batches:
            at = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
            last = functools.reduce(np.logical_or, [a != a[-1] for a in at]).nonzero()[0] if batch.num_rows else []
            first = tuple(a[0] for a in at) if batch.num_rows else None
            if waiting and first is not None and first != tuple(waiting[-1].column(k)[-1].as_py() for k in keys):
                yield from done(waiting)
                waiting = []
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:  # the group that the batch ends with may go on in the next one
                yield from done([*waiting, batch.slice(0, cut)])
                waiting = []
            if cut < batch.num_rows:
                waiting.append(batch.slice(cut))
        if waiting:
            yield from done(waiting)

    return rows.mapInArrow(tidy(run), schema)


def _add(batches):
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x = np.frombuffer(data)
            sums[i] = sums[i] + x if i in sums else x
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["part", "sums"])


def add_up(parts: DataFrame, fan: int = 32) -> DataFrame:
    """Sums of tables that every partition of ``parts`` (part int, sums binary of float64) has made, a table in parts of some kilobytes: one row a part.

    A reduction tree: what at most ``fan`` partitions made is added in one task, level by level, and the parts of a table are dealt over tasks at the last level. So no task reads more than ``fan`` tables, however many partitions there are.
    """
    sums, n = "part int, sums binary", parts.rdd.getNumPartitions()
    while n > fan:
        n = -(-n // fan)
        parts = parts.withColumn("maker", F.spark_partition_id()).repartition(n, "maker").select("part", "sums").mapInArrow(tidy(_add), sums)
    return parts.repartition("part").mapInArrow(tidy(_add), sums)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def bucket_of(id_col: str, modulus: int) -> Column:
    """crc32(doc_id as text) mod ``modulus``: the folds that the contracts name. A null id falls into the fold of the empty text."""
    return (F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)).cast("int")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
