"""What several operators of this package share.

Functions that run inside tasks are shipped by value, so executors need no copy of this package.  A broadcast pickles classes by name,
so models go out as bytes that hold their class by value (`ship`, `received`).  State that should
outlive a task (memo tables of a reused Python worker) hangs on a module object kept in `sys.modules`.
"""

from __future__ import annotations

import ctypes
import gc
import hashlib
import pickle
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.session import CHECKPOINT_KEY, cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["checkpoint", "release", "shared_folder", "fresh_worker", "worker_cache", "ship", "received", "parts_for", "slices", "free_names", "held_out", "read_table", "mix64", "sample_rank"]

checkpoint = cut_lineage


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the one checkpoints go to."""
    if spark.sparkContext.getCheckpointDir() is None:
        configured = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
        if configured is None:
            cut_lineage(spark.range(1))  # only sessions on one machine get here: sets a temporary folder
        else:
            spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir()


def release(spark: SparkSession) -> None:
    """Between rounds of an iteration: Spark deletes shuffle and checkpoint files once the driver has collected the objects that
    stand for them, which a driver with memory to spare may put off until the disks of the executors are full."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def fresh_worker(operator: str, every_task: bool = False) -> None:
    """At the start of a task: what another operator left in this reused worker is dropped and its memory goes back to the system.

    Idle workers else hold the memo tables of all operators of a session beside what the running one needs.  `every_task`: what earlier tasks
    of the same operator freed goes back as well, for operators whose tasks hold much for a short time.
    """
    holder = sys.modules.setdefault("_roadlens_worker_cache", types.ModuleType("_roadlens_worker_cache"))
    if getattr(holder, "operator", None) != operator:
        for name in list(vars(holder)):
            if not name.startswith("__"):
                delattr(holder, name)
        every_task = True
    if every_task:
        gc.collect()
        pa.default_memory_pool().release_unused()
        if sys.platform == "linux":
            getattr(ctypes.CDLL(None), "malloc_trim", int)(0)  # glibc keeps freed memory otherwise
    holder.operator = operator


def worker_cache(name: str, make: Callable[[], object]) -> object:
    """An object of this Python worker process, made at first use."""
    key = "_roadlens_worker_cache"
    if key not in sys.modules:
        sys.modules[key] = types.ModuleType(key)
    holder = sys.modules[key]
    if not hasattr(holder, name):
        setattr(holder, name, make())
    return getattr(holder, name)


def ship(spark: SparkSession, thing: object) -> tuple[object, str]:
    """The thing as a broadcast that executors without this package can read, and a mark of its content."""
    data = cloudpickle.dumps(thing)
    return spark.sparkContext.broadcast(data), hashlib.blake2b(data, digest_size=16).hexdigest()


def received(shipped: tuple[object, str]) -> object:
    """The shipped thing in a task; a worker keeps the last one of each class."""
    shared, mark = shipped
    kept = worker_cache("shipped", dict)
    if mark not in kept:
        thing = pickle.loads(shared.value)
        for other in [m for m, t in kept.items() if type(t).__name__ == type(thing).__name__]:
            del kept[other]
        kept[mark] = thing
    return kept[mark]


def parts_for(rows: int, a_part: int = 200_000) -> int:
    """Partitions for so many rows.  Iterations over small tables else write a file for each of very many empty partitions."""
    return max(1, -(-rows // a_part))


def slices(batch: pa.RecordBatch, column: str, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts together hold about `most` bytes (at least one row each), so that
    what a task holds beside the batch does not depend on how Spark sized the batch."""
    sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    at, total = 0, np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(total, total[at] + most, side="right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def free_names(frame: DataFrame, *wanted: str) -> list[str]:
    """The wanted column names, each lengthened until the frame has no such column (names are compared without case)."""
    taken = {c.lower() for c in frame.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def held_out(doc_id: str = "doc_id"):
    """True for the fifth of all rows that no learner may see the label of; a null id counts as held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(True))


def fold(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string")) % 5


def sample_rank(doc_id: str, salt: int):
    """A fixed random order of rows: bounded samples are the first rows of it."""
    return F.xxhash64(F.lit(salt), F.col(doc_id))


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit integers (finaliser constants of a public generator, fixed values)."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(30))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x = x ^ (x >> np.uint64(27))
        x = x * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))
