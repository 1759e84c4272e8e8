"""Shared helpers of the llm operators: table access, Arrow plumbing and the numpy word kernel.

The kernel works on the UTF-8 bytes of whole Arrow batches.  Word classes of the
contracts are defined on ASCII only, so a byte table decides membership and every
byte of a non-ASCII character belongs to a word.
"""

from __future__ import annotations

import ctypes
import tempfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Bytes of text handled at once by the numpy kernels; bounds their working memory.
CHUNK_BYTES = 1 << 20
#: Rows of an Arrow batch that carries texts.
BATCH_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the named Parquet tables under ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_rows(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only where that is unset and all runs on one machine, as in tests."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = context.getConf().get("spark.checkpoint.dir", None)
        if not configured and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="lumivox-checkpoint-"))
    return context.getCheckpointDir()


#: Folders of checkpoints made inside ``checkpoints_removed``, innermost last.
_scopes: list[list[str]] = []


def materialize(df: DataFrame, counted: bool = False) -> DataFrame:
    """Cut the lineage into the shared checkpoint folder.

    ``counted``: rows are counted as they are written, so that ``at_most`` needs no job;
    every job costs the driver, by its stages, tasks and broadcasts.
    """
    shared_folder(df.sparkSession)
    seen = Observation() if counted else None
    out = (df.observe(seen, F.count(F.lit(1)).alias("rows")) if seen else df).checkpoint(eager=True)
    if seen:
        out._counted_rows = seen.get.get("rows")
    if _scopes:
        file = out._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
        if file.isDefined():
            _scopes[-1].append(file.get())
    return out


def at_most(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has no more than ``rows`` rows; by a job, unless ``materialize`` has counted them."""
    known = vars(df).get("_counted_rows")
    return (df.count() if known is None else known) <= rows


def release_memory() -> None:
    """Gives back what this Python process holds of finished work: the kernel's tables, Arrow's pool and the C heap."""
    _powers.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim is not None:
        trim(0)


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder wherever Spark's file systems reach; one that is gone already is fine."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def checkpoints_removed(spark: SparkSession) -> Iterator[None]:
    """Deletes the checkpoints that the block makes when it ends; what it computes must be written by then."""
    _scopes.append([])
    try:
        yield
    finally:
        for folder in _scopes.pop():
            remove(spark, folder)


def map_texts(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """mapInArrow for rows with texts: Arrow batches hold at most BATCH_ROWS of them, so that long texts don't add up.

    Batches of all sizes give the same results; the setting stays in the session, as
    plans read it when they run.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(run, schema)


def is_held_out(doc_id: str = "doc_id"):
    """crc32(doc_id as text) mod 5 is 0; a null doc_id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


# --- word kernel -----------------------------------------------------------------------------------------------

#: Words `[^\x20\x09-\x0D]+`.
SPACED = np.ones(256, bool)
SPACED[[0x20, 9, 10, 11, 12, 13]] = False
#: Words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` of lower-cased text.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = True
ALNUM[0x41:0x5B] = True  # the table is read before A-Z become a-z
ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True

_FOLD = np.arange(256)
_FOLD[0x41:0x5B] += 32
_RANDOM = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Fingerprint tables: with A-Z lower-cased, and by exact bytes.
FOLDED, EXACT = _RANDOM[_FOLD], _RANDOM
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse modulo 2**64."""
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, CHUNK_BYTES + 4096)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64's constants)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows with about ``limit`` bytes; null texts are empty.

    A longer text forms a run of its own and is never cut.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    first = 0
    while first < n:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def word_bounds(data: np.ndarray, offsets: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and for each row (plus one) the index of its first word."""
    n = len(data)
    if n == 0:
        empty = np.empty(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    inside = members[data]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    edges = offsets[(offsets > 0) & (offsets < n)]
    before[edges] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[edges - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = FOLDED) -> np.ndarray:
    """64-bit fingerprints of words, by default with A-Z lower-cased, equal for equal words wherever they stand.

    Two different words share one with probability about 2**-64; contracts that say
    "equal" hold up to that.
    """
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        origin = starts[first]
        end = max(first + 1, int(np.searchsorted(starts, origin + CHUNK_BYTES)))
        piece = data[origin : ends[end - 1]]
        up, down = _power(len(piece) + 1)
        sums = np.empty(len(piece) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(table[piece] * up[: len(piece)], out=sums[1:])
        s = starts[first:end] - origin
        out[first:end] = (sums[ends[first:end] - origin] - sums[s]) * down[s]
        first = end
    return mix(out)
