"""Token ids in binary files, in ascending order of documents.

Documents are range-partitioned and sorted by id; each task encodes its range and writes
files of at most ``shard_tokens`` ids, so one pass over the texts is enough and memory is
bounded by a file. In a file, ids are replaced by their rank by frequency there and written
byte-aligned: a control stream of two bits per id says how many bytes (1 to 4) its rank takes,
a data stream holds the bytes. Frequent ids take one byte. Decoding is numpy only: a table
gives the four lengths behind each control byte, sums give the places, gathers the ranks.

File: the numbers magic, version, documents, ids and table entries (5 x u32); the table, id of
each rank (u32); ids per document (u32) and document ids (i64; with one bit each for NULL);
control bytes; data bytes. All little-endian. Files appear under their final name when whole,
and only files that the write job returned are read, so a task that ran twice does no harm.

Encoding: parts of a text that begin at a space behind other than white space are tokenized
independently of each other (no alternative of the pattern spans such a place), so a worker
remembers the ids of frequent parts and hands only new ones to the tokenizers library. Equal
parts of a batch are found by hashing, so Python looks at distinct ones only.

Defined cases: NULL is the empty text, which has the end id alone; NULL ids come first; rows
with equal ids follow each other in the order of their texts; special strings become special
ids, as is the library's default; texts of any length; extra columns are ignored; an empty
table writes no file and gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import uuid
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import (
    buffer_of, chunks, materialize, mix, only, partitions, powers_for, prepare, scratch_root, worker_store,
)

MAGIC, VERSION = 0x314B4F54, 1
END_ID = 0
SHARD_TOKENS = 2_000_000
# Parts that one Python worker remembers, and their greatest length.
CACHE_SIZE = 600_000
PART_BYTES = 64
BATCH_PARTS = 256
# Ids below this are counted in a table with a place for each.
DENSE_IDS = 1 << 22
# Characters of a text that range-partitioning compares.
SORT_CHARS = 64

FILES = "path string, task int, number int, n_docs long, n_tokens long"
ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"
BROADCAST_FILES = 100_000


class PartEncoder:
    """Ids of whole texts by the tokenizers library, remembering those of frequent parts."""

    def __init__(self, definition: bytes, cache_size: int = CACHE_SIZE):
        # Spark runs a worker for each core; the library's own threads would only contend.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(definition)
        self.cache, self.cache_size = {}, cache_size
        size = self.tokenizer.get_vocab_size()
        # Remembered ids take two bytes each where the vocabulary allows it.
        self.kind = np.uint16 if size <= 1 << 16 else np.uint32
        special = {i: t.content for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        # Bytes of each id: a byte-level token has one character per byte.
        self.length = np.array(
            [len(special[i].encode()) if i in special else len(self.tokenizer.id_to_token(i) or "") for i in range(size)],
            np.int64)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.kind) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, parts: list[bytes]) -> list[bytes]:
        """Ids of parts that each stand behind a space, all encoded as one text and cut by byte counts."""
        found, width = [], np.dtype(self.kind).itemsize
        lots = [parts[i:i + BATCH_PARTS] for i in range(0, len(parts), BATCH_PARTS)]
        for some, ids in zip(lots, self.whole([b"".join([b" " + p for p in some]).decode("utf-8") for some in lots])):
            ends = np.cumsum([len(p) + 1 for p in some])
            at = (np.searchsorted(np.cumsum(self.length[ids]), ends, side="left") + 1) * width
            raw, at = ids.tobytes(), at.tolist()
            found += [raw[a:b] for a, b in zip([0, *at], at)]
        return found

    def _ids_of(self, data: np.ndarray, raw: bytes, start: np.ndarray, end: np.ndarray) -> tuple:
        """``pool, from, length``: ids of distinct parts in one array, and where those of each part lie."""
        which, of = distinct_parts(data, start, end)
        cache, some = self.cache, [raw[a:b] for a, b in zip(start[which].tolist(), end[which].tolist())]
        held = [cache.get(p) for p in some]
        new = [i for i, ids in enumerate(held) if ids is None]
        for i, ids in zip(new, self._learn([some[i] for i in new])):
            held[i] = ids
        if len(cache) < self.cache_size:
            cache.update((some[i], held[i]) for i in new if len(some[i]) <= PART_BYTES)
        pool = np.frombuffer(b"".join(held), self.kind)
        length = np.array([len(x) for x in held], np.int64) // np.dtype(self.kind).itemsize
        return pool, (np.cumsum(length) - length)[of], length[of]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each text's followed by the end id, and how many each has.

        Of a text's parts, the first has no space before it and the last may end in white space: they are encoded by
        themselves. All others have the same ids wherever they stand.
        """
        data, offsets = buffer_of(texts)
        raw, n = data.tobytes(), len(offsets) - 1
        cut = cuts(data, offsets)
        owner = np.searchsorted(offsets, cut, side="right") - 1
        end = np.minimum(np.append(cut[1:], len(data)), offsets[owner + 1]) if len(cut) else cut
        of_text = np.searchsorted(owner, np.arange(n + 1))
        has = of_text[1:] > of_text[:-1]
        first_end, last_from = offsets[1:].copy(), offsets[1:].copy()
        first_end[has] = cut[of_text[:-1][has]]
        last_from[has] = cut[of_text[1:][has] - 1]
        ends = self.whole([raw[a:b].decode("utf-8") for a, b in [
            *zip(offsets[:-1].tolist(), first_end.tolist()), *zip(last_from.tolist(), offsets[1:].tolist())]])
        middle = np.ones(len(cut), bool)
        middle[of_text[1:][has] - 1] = False
        pool, at, length = self._ids_of(data, raw, cut[middle] + 1, end[middle])

        # Pieces in order: each text's first part, its middle ones, its last one, the end id.
        ends_length = np.array([len(x) for x in ends], np.int64)
        ends_at = len(pool) + np.cumsum(ends_length) - ends_length
        pool = np.concatenate([pool, *ends, np.array([END_ID], self.kind)])
        inner = np.bincount(owner[middle], minlength=n)
        base = np.cumsum(inner + 3) - (inner + 3)
        piece_at, piece_length = np.zeros(int(inner.sum()) + 3 * n, np.int64), np.zeros(int(inner.sum()) + 3 * n, np.int64)
        mine = base[owner[middle]] + 1 + np.arange(int(inner.sum())) - (np.cumsum(inner) - inner)[owner[middle]]
        for where, x, y in ((base, ends_at[:n], ends_length[:n]), (mine, at, length),
                            (base + 1 + inner, ends_at[n:], ends_length[n:]), (base + 2 + inner, len(pool) - 1, 1)):
            piece_at[where], piece_length[where] = x, y
        ids = pool[np.repeat(piece_at - (np.cumsum(piece_length) - piece_length), piece_length) + np.arange(int(piece_length.sum()))]
        return ids, np.add.reduceat(piece_length, base)


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places of spaces inside a text that follow something else than white space.

    White space is also what ends in the bytes of a Unicode space; where that is unsure there is no cut.
    """
    at = np.flatnonzero(data == 32)
    begins = np.zeros(len(data) + 1, bool)
    begins[offsets] = True
    at = at[~begins[at]]
    one, two, three = data[at - 1], data[at - 2], data[at - 3]
    white = (one <= 32) | (two == 0xC2) & ((one == 0x85) | (one == 0xA0)) | (
        (three >= 0xE1) & (three <= 0xE3) & ((two == 0x80) | (two == 0x81) | (two == 0x9A)))
    return at[~white]


def distinct_parts(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One part of each distinct content, and the number of each part's content; by two 64-bit hashes."""
    powers, inverse, value = powers_for(len(data) + 1)
    names = []
    for values in (value, mix(value)):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[data] * powers[:len(data)], out=sums[1:])
        names.append((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    _, which, of = np.unique(names[0], return_index=True, return_inverse=True)
    if (names[1][which][of] != names[1]).any():
        _, which, of = np.unique(np.stack(names, axis=1), axis=0, return_index=True, return_inverse=True)
    return which, of.ravel()


def _filesystem(folder: str):
    """Where a shared folder lies, as pyarrow sees it, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if ":" in folder.split("/")[0] else (fs.LocalFileSystem(), folder)


def pack(doc_ids: list, counts: np.ndarray, ids: np.ndarray) -> bytes:
    """One file's bytes."""
    names = None
    if len(ids) and int(ids.max()) >= DENSE_IDS:
        names, ids = np.unique(ids, return_inverse=True)
    times = np.bincount(ids)
    values = np.flatnonzero(times)
    order = np.lexsort((values, -times[values]))
    rank_of = np.zeros(len(times), np.uint32)
    rank_of[values[order]] = np.arange(len(values), dtype=np.uint32)
    ranks = rank_of[ids]
    size = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    quads = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    quads[:len(ranks)] = size - 1
    quads = quads.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    split = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)
    data = split[np.arange(4) < size[:, None]]
    missing = np.array([d is None for d in doc_ids], bool)
    known = np.array([0 if d is None else d for d in doc_ids], "<i8")
    head = np.array([MAGIC, VERSION, len(doc_ids), len(ids), len(values)], "<u4")
    table = values[order] if names is None else names[values[order]]
    return b"".join([head.tobytes(), table.astype("<u4").tobytes(), counts.astype("<u4").tobytes(),
                     known.tobytes(), np.packbits(missing).tobytes(), control.astype(np.uint8).tobytes(), data.tobytes()])


# Bytes per rank behind each control byte.
LENGTHS = np.array([[1 + (c >> 2 * i & 3) for i in range(4)] for c in range(256)], np.uint8)


def unpack(raw: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """``doc_ids, ids per document, ids`` of a file; raises ValueError where it is none."""
    head = np.frombuffer(raw, "<u4", 5)
    if head[0] != MAGIC or head[1] != VERSION:
        raise ValueError("not a token file")
    n_docs, n_ids, n_values = (int(x) for x in head[2:])
    at = 20

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        part = np.frombuffer(raw, kind, count, at)
        at += part.nbytes
        return part

    table, counts, known = take("<u4", n_values), take("<u4", n_docs), take("<i8", n_docs)
    missing = np.unpackbits(take("u1", -(-n_docs // 8)))[:n_docs]
    size = LENGTHS[take("u1", -(-n_ids // 4))].ravel()[:n_ids]
    place = np.cumsum(size, dtype=np.int64) - size
    data = np.frombuffer(raw, np.uint8, -1, at)
    ranks = np.zeros(n_ids, np.uint32)
    for byte in range(4):
        some = np.flatnonzero(size > byte) if byte else slice(None)
        ranks[some] |= data[place[some] + byte].astype(np.uint32) << np.uint32(8 * byte)
    doc_ids = [None if m else int(k) for k, m in zip(known.tolist(), missing.tolist())]
    return doc_ids, counts.astype(np.int64), table[ranks].astype("<u4")


def write_files(docs: DataFrame, folder: str, path: str | None = None, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Encode and write ``docs`` under ``folder`` (shared by all executors); one row per file."""
    spark = prepare(docs.sparkSession)
    definition = spark.sparkContext.broadcast(open(path or public_tokenizers.path("byte_bpe_50k.json"), "rb").read())
    texts = only(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    # Ranges by the text's beginning too: rows without an id, or of one id, need not lie in one task.
    beginning = F.substring("text", 1, SORT_CHARS)
    ordered = texts.repartitionByRange(partitions(spark), "doc_id", beginning).sortWithinPartitions("doc_id", "text")

    def run(batches):
        store = worker_store()
        key = ("parts", hashlib.sha256(definition.value).digest())
        if key not in store:
            store[key] = PartEncoder(definition.value)
        encoder, task = store[key], TaskContext.get().partitionId()
        where, root = _filesystem(folder)
        doc_ids, arrays, counts, pending, number = [], [], [], 0, 0

        def flush():
            name = f"{root}/{task:07d}-{number:05d}-{uuid.uuid4().hex}"
            where.create_dir(root, recursive=True)
            with where.open_output_stream(f"{name}.tmp") as out:
                out.write(pack(doc_ids, np.concatenate(counts), np.concatenate(arrays)))
            where.move(f"{name}.tmp", f"{name}.tok")
            return pa.record_batch({
                "path": [f"{name}.tok"], "task": pa.array([task], pa.int32()), "number": pa.array([number], pa.int32()),
                "n_docs": pa.array([len(doc_ids)], pa.int64()), "n_tokens": pa.array([pending], pa.int64())})

        for batch in batches:
            for part in chunks(batch):
                ids, n_ids = encoder.encode(part.column("text"))
                known, ends, done = part.column("doc_id").to_pylist(), np.cumsum(n_ids), 0
                while done < len(known):
                    begin = int(ends[done] - n_ids[done])
                    # Up to the document that fills the file, or all there are.
                    upto = min(int(np.searchsorted(ends, begin + shard_tokens - pending)) + 1, len(known))
                    doc_ids += known[done:upto]
                    arrays.append(ids[begin:int(ends[upto - 1])])
                    counts.append(n_ids[done:upto])
                    pending, done = pending + int(ends[upto - 1]) - begin, upto
                    if pending >= shard_tokens:
                        yield flush()
                        doc_ids, arrays, counts, pending, number = [], [], [], 0, number + 1
        if doc_ids:
            yield flush()

    return ordered.mapInArrow(run, FILES)


def read_files(spark, files: DataFrame, folder: str) -> DataFrame:
    """Per document of the written ``files``: start among all ids, count and crc32, in no order."""
    n_files = files.count()
    if not n_files:
        return spark.createDataFrame([], ROWS)
    # Ids before a file: those of earlier tasks, from one row a task, and of the task's earlier files.
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("task").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    tasks = files.groupBy("task").agg(F.sum("n_tokens").alias("n")).select(
        "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("tasks_before"))
    name = F.regexp_extract("path", "([^/]*)$", 1).alias("name")
    starts = files.join(F.broadcast(tasks), "task").select(
        name, (F.col("tasks_before") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).alias("before"))

    def run(batches):
        for batch in batches:
            for before, raw in zip(batch.column("before").to_pylist(), batch.column("content")):
                doc_ids, counts, ids = unpack(raw.as_buffer())
                ends = np.cumsum(counts)
                crc = [zlib.crc32(ids[b - n:b].tobytes()) for b, n in zip(ends.tolist(), counts.tolist())]
                yield pa.record_batch({
                    "doc_id": pa.array(doc_ids, pa.int64()), "start": pa.array(before + ends - counts),
                    "n_tokens": pa.array(counts),
                    "ids_crc32": pa.array(crc, pa.int64())})

    # The list of files is broadcast while it is small: a row of it takes some hundred bytes.
    side = F.broadcast(starts) if n_files <= BROADCAST_FILES else starts
    content = spark.read.format("binaryFile").option("pathGlobFilter", "*.tok").load(folder).select(name, "content")
    return content.join(side, "name").select("before", "content").mapInArrow(run, ROWS)


def token_file_digests(docs: DataFrame, path: str | None = None, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write all of ``docs`` to files in the shared scratch folder, and report what reading them gives."""
    spark = prepare(docs.sparkSession)
    folder = f"{scratch_root(spark)}/tokens-{uuid.uuid4().hex}"
    files = materialize(write_files(docs, folder, path, shard_tokens), "token-files")
    return read_files(spark, files, folder)
