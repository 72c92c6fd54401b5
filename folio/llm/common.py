"""Helpers shared by the operators: Arrow row batches, word shingles, guarded broadcasts, written tables."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from folio.session import checkpoint_dir, scratch_path

ROWS_PER_SLICE = 256  # rows handled at once inside a task
BROADCAST_ROWS = 1_000_000  # a list of ids (8 bytes each) is broadcast up to this many rows, joined by shuffle beyond
SHINGLE_WORDS = 5
SIMILARITY = 0.8

Columns = dict[str, list]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Arrow batches between the JVM and Python: texts are long, and buffers of 10,000 of them (Spark's default) stay allocated.
ARROW_LIMITS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "512", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}


def map_rows(df: DataFrame, fn: Callable[[Iterator[Columns]], Iterator[Columns]], schema: str) -> DataFrame:
    """Run ``fn`` over slices of at most ROWS_PER_SLICE rows (columns as Python lists) of each partition.

    Where the session does not limit Arrow batches itself, ARROW_LIMITS hold for it from now on (a bound of memory;
    results do not depend on it)."""
    out = to_arrow_schema(T.StructType.fromDDL(schema))
    conf = df.sparkSession.conf
    for key, limit in ARROW_LIMITS.items():
        if conf.get(key, "7") == "7":  # 7: not set; what the session sets itself stays
            conf.set(key, limit)

    def run(batches):
        asked = times_asked()

        def slices():
            for b in batches:
                for at in range(0, b.num_rows, ROWS_PER_SLICE):
                    yield b.slice(at, ROWS_PER_SLICE).to_pydict()

        try:
            for cols in fn(slices()):
                yield pa.RecordBatch.from_arrays([pa.array(cols[f.name], type=f.type) for f in out], schema=out)
        finally:
            let_go(asked)
            pa.default_memory_pool().release_unused()  # else an idle worker holds what its largest batches took

    return df.mapInArrow(run, schema)


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write the table to the shared folder (spark.checkpoint.dir) and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """``checkpoint()`` in the shared folder, for small tables of loops."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def join_ids(df: DataFrame, ids: DataFrame, on: str, how: str, n_ids: int | None = None) -> DataFrame:
    """Join with a list of ids: broadcast only when its counted size is within BROADCAST_ROWS."""
    n = ids.count() if n_ids is None else n_ids
    return df.join(F.broadcast(ids) if n <= BROADCAST_ROWS else ids, on, how)


_resident: dict = {}
_asked = [0]  # how often this worker has asked for what it keeps


def _give_back() -> None:
    """What was freed goes back to the system, where the C library can do that: an operator's model is not held beside the next."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def resident(key, build: Callable):
    """What a Python worker keeps between tasks (a vocabulary with its remembered words): one object at a time,
    so that the operators that a worker serves in turn don't add up."""
    _asked[0] += 1
    if key not in _resident:
        _resident.clear()
        _give_back()
        _resident[key] = build()
    return _resident[key]


def times_asked() -> int:
    return _asked[0]


def let_go(asked: int) -> None:
    """At the end of a task that has asked for nothing since (its operator keeps nothing): what another operator kept goes."""
    if _asked[0] == asked:
        _resident.clear()
        _give_back()


WORDS = re.compile(r"\w+")


class WordHashes(dict):
    """64-bit hashes of words, remembered; forgets everything when it grows past ``most``."""

    most = 200_000

    def __missing__(self, word: str) -> int:
        if len(self) >= self.most:
            self.clear()
        h = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        self[word] = h
        return h


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of word characters."""
    return WORDS.findall(text.lower()) if text else []


_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]


def shingle_hashes(words: list[str], known: WordHashes, width: int = SHINGLE_WORDS) -> np.ndarray:
    """One 64-bit hash for each run of ``width`` (at most SHINGLE_WORDS) words; a shorter text that has words is one shingle."""
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, n)
    width = min(width, n)
    out = h[: n - width + 1] * _MIX[0]
    for k in range(1, width):
        out ^= out >> np.uint64(29)
        out = (out + h[k : n - width + 1 + k]) * _MIX[k]
    out ^= out >> np.uint64(32)
    out *= _MIX[4]
    out ^= out >> np.uint64(29)
    return out


def odd_multipliers(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit multipliers: x -> x * a permutes the 64-bit integers."""
    return np.random.default_rng(seed).integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
