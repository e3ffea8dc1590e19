"""Line deduplication: sorted hashes are streamed, and a compressed bitmap per document says which lines stay.

Keys of at least ``min_chars`` code points found in at least ``min_docs`` documents lose
their lines everywhere but in the document with the largest id. Lines travel as 128-bit
hashes, one row for all places of a key in a text, range-partitioned and sorted by (hash,
document descending), so a line that a third of all documents share is spread over several tasks. A task streams its rows
and decides every run of equal hashes that begins and ends inside it; rows of the one run
that may reach over a task's beginning or end are decided by a small table of those hashes.

Defined cases: a NULL or empty text is one empty line; rows with a NULL id keep all lines and
count for no key; rows that share an id are one document for counting, each with a bitmap of
its own; no limit on the length of texts or lines; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WHITE, buffer_of, by_place, chunks, free_names, materialize, only, partitions, prepare

LINES = "doc_id long, text_hash long, pos binary, h1 long, h2 long"
DECIDED = "doc_id long, text_hash long, pos binary, h1 long, h2 long, open boolean"
# Bitmaps are broadcast up to so many bytes; beyond, they are joined by shuffle.
BROADCAST_BYTES, ROW_BYTES = 32 << 20, 64


def line_key(line: bytes) -> bytes:
    """The compared form of a line: ASCII white space off both ends, A-Z in lower case."""
    return line.strip(WHITE).lower()


def _line_rows(batches, min_chars: int):
    for batch in batches:
        for part in chunks(batch):
            data, offsets = buffer_of(part.column("text"))
            raw = data.tobytes()
            owner, pos, digests = [], [], []
            for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                places = {}
                for p, line in enumerate(raw[a:b].split(b"\n")):
                    if len(line) >= min_chars:
                        key = line_key(line)
                        if len(key) >= min_chars and (key.isascii() or len(key.decode("utf-8", "replace")) >= min_chars):
                            places.setdefault(key, []).append(p)
                owner += [i] * len(places)
                pos += [np.array(at, np.int32).tobytes() for at in places.values()]
                digests += [hashlib.blake2b(key, digest_size=16).digest() for key in places]
            if owner:
                pair = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                yield pa.record_batch({
                    "doc_id": part.column("doc_id").take(pa.array(owner)),
                    "text_hash": part.column("text_hash").take(pa.array(owner)),
                    "pos": pa.array(pos, pa.binary()), "h1": pair[:, 0].copy(), "h2": pair[:, 1].copy()})


def _decide(batches, min_docs: int):
    """Stream sorted rows; emit dropped rows, and rows of runs that may cross a task's edge as ``open``."""
    names = ("doc_id", "text_hash", "pos", "h1", "h2")

    def emit(rows, is_open):
        return pa.record_batch({**{n: rows[n] for n in names if n != "pos"}, "pos": pa.array(rows["pos"], pa.binary()),
                                "open": np.full(len(rows["pos"]), is_open)}).select([*names, "open"])

    first = None          # the key this task began with: its rows stay open
    held = None           # rows of the current run while it has fewer than min_docs documents
    deep = None           # (key, witness rows) of a current run known to reach min_docs
    for batch in batches:
        rows = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in names}
        if not len(rows["pos"]):
            continue
        if first is None:
            first = (rows["h1"][0], rows["h2"][0])
        begins = (rows["h1"] == first[0]) & (rows["h2"] == first[1])
        if begins.any():
            yield emit({n: v[begins] for n, v in rows.items()}, True)
            rows = {n: v[~begins] for n, v in rows.items()}
        if deep is not None and len(rows["pos"]):
            same = (rows["h1"] == deep[0][0]) & (rows["h2"] == deep[0][1])
            if same.any():
                yield emit({n: v[same] for n, v in rows.items()}, False)
                rows = {n: v[~same] for n, v in rows.items()}
            if len(rows["pos"]):
                deep = None
        if held is not None:
            rows = {n: np.concatenate([held[n], rows[n]]) for n in names}
            held = None
        count = len(rows["pos"])
        if not count:
            continue
        new_key = np.ones(count, bool)
        new_key[1:] = (np.diff(rows["h1"]) != 0) | (np.diff(rows["h2"]) != 0)
        new_doc = new_key.copy()
        new_doc[1:] |= np.diff(rows["doc_id"]) != 0
        start = np.flatnonzero(new_key)
        run = np.cumsum(new_key) - 1
        so_far = np.cumsum(new_doc)
        rank = so_far - so_far[start][run] + 1
        documents = np.maximum.reduceat(rank, start)
        drop = (documents[run] >= min_docs) & (rank >= 2)
        if drop.any():
            yield emit({n: v[drop] for n, v in rows.items()}, False)
        last = slice(start[-1], count)
        if documents[-1] >= min_docs:
            witness = np.flatnonzero(new_doc[last])[:min_docs] + start[-1]
            deep = ((rows["h1"][-1], rows["h2"][-1]), {n: v[witness] for n, v in rows.items()})
        else:
            held = {n: v[last] for n, v in rows.items()}
    if held is not None:
        yield emit(held, True)
    if deep is not None:
        # Rows already dropped; named again so that the next task's part of the run is counted with them.
        yield emit(deep[1], True)


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``doc_id, text_hash, n_dropped, keep``: a compressed bitmap for each text that loses lines.

    Bit p of ``keep`` (zlib over packed bits, the last byte filled up with ones) is line p; lines past
    its end stay. Rows with the same id and text share a bitmap.
    """
    spark = prepare(docs.sparkSession)
    texts = only(docs, "doc_id", "text").filter(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash"))
    lines = materialize(texts.mapInArrow(lambda it: _line_rows(it, min_chars), LINES), "lines")
    order = [F.col("h1"), F.col("h2"), F.col("doc_id").desc()]
    ranged = lines.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order, "text_hash")
    decided = materialize(ranged.mapInArrow(lambda it: _decide(it, min_docs), DECIDED), "line-decisions")

    # At most two hashes of each task are open, whatever the input holds.
    pending = decided.filter("open")
    keys = pending.select("h1", "h2", "doc_id").distinct().groupBy("h1", "h2").agg(
        F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keeper")).filter(F.col("n_docs") >= min_docs)
    late = pending.join(F.broadcast(keys), ["h1", "h2"]).filter(F.col("doc_id") != F.col("keeper"))
    dropped = decided.filter("not open").select("doc_id", "text_hash", "pos").unionByName(
        late.select("doc_id", "text_hash", "pos"))
    by_text = dropped.groupBy("doc_id", "text_hash").agg(F.collect_list("pos").alias("lost"))
    return by_text.mapInArrow(_bitmaps, "doc_id long, text_hash long, n_dropped long, keep binary")


def _bitmaps(batches):
    for batch in batches:
        counts, packed = [], []
        for lost in batch.column("lost"):
            at = np.unique(np.frombuffer(b"".join(lost.as_py()), np.int32))
            # Whole bytes: a zero added by packing would read as a dropped line.
            bits = np.ones((int(at[-1]) // 8 + 1) * 8, bool)
            bits[at] = False
            counts.append(len(at))
            packed.append(zlib.compress(np.packbits(bits).tobytes()))
        yield pa.record_batch({
            "doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash"),
            "n_dropped": pa.array(counts, pa.int64()), "keep": pa.array(packed, pa.binary())})


def kept_lines(text: str | None, keep: bytes | None) -> str:
    """The text without the lines that its bitmap drops."""
    if keep is None or text is None:
        return text or ""
    lines = text.split("\n")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8)).astype(bool)[:len(lines)].tolist()
    bits += [True] * (len(lines) - len(bits))
    return "\n".join(line for line, stays in zip(lines, bits) if stays)


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, str, str]:
    """``docs`` (``doc_id, text``) with two more columns, and their names: lines lost, bitmap.

    The bitmaps are stored and measured: small ones are broadcast, so that the texts stay where they lie.
    """
    held = materialize(bitmaps, "bitmaps")
    rows, size = held.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("keep")), F.lit(0))).first()
    names = free_names(docs, "of_id", "of_text", "n_dropped", "keep")
    side = held.select("doc_id", "text_hash", "n_dropped", "keep").toDF(*names)
    if size + ROW_BYTES * rows <= BROADCAST_BYTES:
        side = F.broadcast(side)
    match = (docs[doc_id] == side[names[0]]) & (F.xxhash64(docs[text]) == side[names[1]])
    return docs.join(side, match, "left").drop(*names[:2]), names[2], names[3]


def line_digests(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256`` for every row of ``docs``."""
    texts = only(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    joined, lost, bits = with_bitmaps(texts, keep_bitmaps(texts, min_chars, min_docs))

    def digest(batches):
        for batch in batches:
            for part in chunks(batch):
                n_lines, hashes = [], []
                for text, keep in zip(part.column("text").to_pylist(), part.column(bits).to_pylist()):
                    n_lines.append((text or "").count("\n") + 1)
                    hashes.append(hashlib.sha256(kept_lines(text, keep).encode("utf-8", "surrogatepass")).hexdigest())
                yield pa.record_batch({
                    "doc_id": part.column("doc_id"), "n_lines": pa.array(n_lines, pa.int64()),
                    "n_dropped": part.column(lost).fill_null(0), "kept_sha256": pa.array(hashes, pa.string())})

    return joined.mapInArrow(digest, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def drop_repeated_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text`` (a NULL text stays NULL); other columns as they were."""
    rows, doc_id, body = by_place(docs, "doc_id", "text")
    joined, lost, bits = with_bitmaps(rows, keep_bitmaps(docs, min_chars, min_docs), doc_id, body)
    fields, names = rows.schema, rows.columns
    at = names.index(body)

    def apply(batches):
        for batch in batches:
            for part in chunks(batch, body):
                keep = part.column(bits).to_pylist()
                texts = part.column(body).to_pylist()
                texts = [t if k is None else kept_lines(t, k) for t, k in zip(texts, keep)]
                columns = [part.column(n) for n in names]
                columns[at] = pa.array(texts, part.column(body).type)
                yield pa.record_batch(columns, names=names)

    return joined.mapInArrow(apply, fields).toDF(*docs.columns)
