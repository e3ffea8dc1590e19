"""Shared by the text operators: session settings, bounded batches, and words as numpy arrays."""

from __future__ import annotations

import sys
import types
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import apply_settings, materialize, scratch_root

__all__ = ["materialize", "scratch_root"]

# Text handled at once by numpy; temporaries take about forty times as much.
CHUNK_BYTES = 2 << 20
SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
    "spark.sql.execution.arrow.useLargeVarTypes": "true",
}
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
WHITE = bytes([9, 10, 11, 12, 13, 32])


def prepare(spark: SparkSession) -> SparkSession:
    """The library's settings, and Arrow batches bounded by rows and by bytes."""
    apply_settings(spark)
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_of_id(name: str = "doc_id") -> Column:
    """crc32 of the id's decimal text (a missing id counts as the empty text)."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary"))


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns, whatever other columns there are.

    Where a name is repeated, or differs from another one in case only, the first column of
    exactly that name counts.
    """
    if len({c.lower() for c in df.columns}) == len(df.columns):
        return df.select(*names)
    unique = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return unique.select(*[F.col(f"_{df.columns.index(n)}").alias(n) for n in names])


def by_place(df: DataFrame, *wanted: str) -> tuple[DataFrame, ...]:
    """``df`` with its columns named by their place, and the new names of ``wanted`` (the first column of exactly that name).

    ``toDF`` with the old names undoes it; in between no name is ambiguous, whatever names there are.
    """
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]), *[f"c{df.columns.index(n)}" for n in wanted]


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """``wanted`` with so many underscores in front that no column of ``df`` has any of the names."""
    taken, lead = {c.lower() for c in df.columns}, "_"
    while any(lead + name in taken for name in wanted):
        lead += "_"
    return [lead + name for name in wanted]


def worker_store() -> dict:
    """A dictionary that lives as long as the Python worker, over all its tasks."""
    return sys.modules.setdefault("_llm_worker_store", types.ModuleType("_llm_worker_store")).__dict__


def share(spark: SparkSession, value, kind: str):
    """A function that gives a broadcast copy of ``value`` in tasks.

    Objects of this package travel by value, so workers need no copy of it. A worker keeps the last value of a kind.
    """
    sent, key = spark.sparkContext.broadcast(cloudpickle.dumps(value)), uuid.uuid4().hex

    def get():
        held = worker_store().get(kind)
        if held is None or held[0] != key:
            held = worker_store()[kind] = (key, cloudpickle.loads(sent.value))
        return held[1]

    return get


def chunks(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES):
    """Slices of ``batch`` of about ``limit`` bytes of text; a longer text is a slice of its own."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes) // limit
    edges = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [batch.num_rows]])
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if b > a:
            yield batch.slice(a, b - a)


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each begins (one more entry than texts). NULL is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit integers (the finaliser of a well-known public hash)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def powers_for(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse, and a random value for each byte."""
    store = worker_store()
    if len(store.get("powers", ())) < n:
        size = max(n, CHUNK_BYTES + (1 << 17))
        for name, base in (("powers", BASE), ("inverse", pow(BASE, -1, 1 << 64))):
            run = np.full(size, base, np.uint64)
            run[0] = 1
            store[name] = np.cumprod(run)
        store["bytes"] = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
    return store["powers"], store["inverse"], store["bytes"]


def table_of(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


def not_alphanumeric() -> bytes:
    """ASCII bytes that are no letter or digit: as separators they leave words without punctuation."""
    return bytes(b for b in range(128) if not chr(b).isalnum())


class Words:
    """Words of a run of texts: ``start`` and ``end`` in ``data``, ``first[i]:first[i+1]`` those of text i."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, separators: bytes = WHITE):
        self.data, self.offsets = data, offsets
        n = len(data)
        if not n:
            self.start = self.end = np.zeros(0, np.int64)
            self.first = np.zeros(len(offsets), np.int64)
            return
        gap = table_of(separators)[data]
        before, after = np.empty(n, bool), np.empty(n, bool)
        before[1:], after[:-1] = gap[:-1], gap[1:]
        inner = offsets[(offsets > 0) & (offsets < n)]
        before[0] = after[-1] = True
        before[inner], after[inner - 1] = True, True
        inside = ~gap
        self.start, self.end = np.flatnonzero(inside & before), np.flatnonzero(inside & after) + 1
        self.first = np.searchsorted(self.start, offsets)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """The text number of every word."""
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word: prefix sums of a polynomial, so the cost is per byte, not per word."""
        n = len(self.data)
        powers, inverse, value = powers_for(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(value[self.data] * powers[:n], out=sums[1:])
        own = (sums[self.end] - sums[self.start]) * inverse[self.start]
        return mix(own + (self.end - self.start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def strings(self, index: np.ndarray) -> list[bytes]:
        raw = self.data.tobytes()
        return [raw[a:b] for a, b in zip(self.start[index].tolist(), self.end[index].tolist())]


def windows(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words inside a text, and the index of their first word."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for i in range(k):
        total = total * np.uint64(BASE) + hashes[i:i + n]
    inside = np.ones(len(hashes) + 1, bool)
    for i in range(1, k):
        at = first[1:] - i
        inside[at[at >= 0]] = False
    # A text shorter than k words must not open windows either: its words all lie within k-1 of its end.
    keep = np.flatnonzero(inside[:n])
    return mix(total[keep]), keep


def shingles(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of ``k`` words with their text number; a text of fewer words gives one shingle of all of them."""
    found, at = windows(hashes, first, k)
    owner = np.searchsorted(first, at, side="right") - 1
    few = np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < k))
    if len(few):
        extra = np.array([int(mix(np.array([sum_of(hashes[first[i]:first[i + 1]])], np.uint64))[0]) for i in few.tolist()], np.uint64)
        found, owner = np.concatenate([found, extra]), np.concatenate([owner, few])
        order = np.argsort(owner, kind="stable")
        found, owner = found[order], owner[order]
    return found, owner


def sum_of(hashes: np.ndarray) -> int:
    total = len(hashes)
    for h in hashes.tolist():
        total = (total * BASE + h) & 0xFFFFFFFFFFFFFFFF
    return total


LETTERS_ASCII = bytes([*range(65, 91), *range(97, 123)])
