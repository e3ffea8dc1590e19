"""Byte-level BPE as a reduction over a tree of text pieces.

A text is halved until a piece is short; pieces are encoded by themselves and joined with
their neighbour. The join re-encodes a window around the cut. The window grows on both sides
until it begins and ends where white space follows a word character: no alternative of the
pattern matches across such a place, whatever stands around it, so tokens outside the window
cannot change. Joining is associative, with the empty text as its neutral element. Decoding
concatenates up the same tree.

Defined cases: NULL is the empty text, with no tokens; ids repeat as rows do; special strings
are ordinary text; the length of a text is not limited (a text without any white space is one
window); extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, only, prepare, worker_store

LEAF_CHARS = 8192
FIRST_WINDOW = 32
SAFE = re.compile(r"(?<=\w)[ \n]")


class TreeCodec:
    """Encodes and decodes by halves; ``encode`` gives the ids of any text as an array."""

    def __init__(self, encode, decode, leaf_chars: int = LEAF_CHARS):
        self.encode_piece, self.decode_piece, self.leaf = encode, decode, max(1, leaf_chars)

    def encode(self, text: str) -> np.ndarray:
        if len(text) <= self.leaf:
            return self.encode_piece(text)
        return self._encode(text, 0, len(text))

    def _encode(self, text: str, a: int, b: int) -> np.ndarray:
        if b - a <= self.leaf:
            return self.encode_piece(text[a:b])
        middle = (a + b) // 2
        return self.join(text, a, middle, b, self._encode(text, a, middle), self._encode(text, middle, b))

    def join(self, text: str, a: int, middle: int, b: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ids of ``text[a:b]`` from those of ``text[a:middle]`` and ``text[middle:b]``."""
        width, low, high = FIRST_WINDOW, None, None
        while low is None or high is None:
            if low is None:
                begin = max(a, middle - width)
                # The word character before a safe place must lie in the left half too, hence not ``a`` itself.
                found = [m.start() for m in SAFE.finditer(text, begin, middle) if m.start() > a]
                low = found[-1] if found else (a if begin == a else None)
            if high is None:
                end = min(b, middle + width)
                found = SAFE.search(text, middle + 1, end)
                high = found.start() if found else (b if end == b else None)
            width *= 2
        tail = len(self.encode_piece(text[low:middle])) if low > a else len(left)
        head = len(self.encode_piece(text[middle:high])) if high < b else len(right)
        return np.concatenate([left[:len(left) - tail], self.encode_piece(text[low:high]), right[head:]])

    def decode(self, ids: np.ndarray, leaf_ids: int = LEAF_CHARS) -> bytes:
        if len(ids) <= leaf_ids:
            return self.decode_piece(ids)
        middle = len(ids) // 2
        return self.decode(ids[:middle], leaf_ids) + self.decode(ids[middle:], leaf_ids)


def codec_of(rank_file: bytes, leaf_chars: int = LEAF_CHARS) -> TreeCodec:
    """The codec of a rank file; made once for each Python worker."""
    store, key = worker_store(), ("bpe", hashlib.sha256(rank_file).digest(), leaf_chars)
    if key not in store:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines())}
        encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

        def encode(text: str) -> np.ndarray:
            return encoding.encode_to_numpy(text, disallowed_special=())

        store[key] = TreeCodec(encode, lambda ids: encoding.decode_bytes(ids.tolist()), leaf_chars)
    return store[key]


def encode_texts(docs: DataFrame, path: str | None = None, column: str = "ids", leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """``docs`` (without repeated names) with the ids of ``text`` as an array column."""
    spark = prepare(docs.sparkSession)
    ranks = spark.sparkContext.broadcast(open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read())
    schema = docs.withColumn(column, F.lit(None).cast("array<int>")).schema

    def run(batches):
        codec = codec_of(ranks.value, leaf_chars)
        for batch in batches:
            for part in chunks(batch):
                ids = [codec.encode(t or "").astype(np.int32) for t in part.column("text").to_pylist()]
                yield pa.record_batch([*part.columns, pa.array(ids, pa.list_(pa.int32()))], names=schema.names)

    return docs.mapInArrow(run, schema)


def decode_ids(docs: DataFrame, path: str | None = None, column: str = "ids", into: str = "decoded") -> DataFrame:
    """``docs`` with the bytes that the ids of ``column`` stand for (NULL: none)."""
    spark = prepare(docs.sparkSession)
    ranks = spark.sparkContext.broadcast(open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read())
    schema = docs.withColumn(into, F.lit(None).cast("binary")).schema

    def run(batches):
        codec = codec_of(ranks.value)
        for batch in batches:
            decoded = [codec.decode(np.asarray(ids or [], np.uint32)) for ids in batch.column(column).to_pylist()]
            yield pa.record_batch([*batch.columns, pa.array(decoded, pa.binary())], names=schema.names)

    return docs.mapInArrow(run, schema)


def round_trip_digests(docs: DataFrame, path: str | None = None, leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row: encoded, then decoded from the ids."""
    spark = prepare(docs.sparkSession)
    ranks = spark.sparkContext.broadcast(open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read())

    def run(batches):
        codec = codec_of(ranks.value, leaf_chars)
        for batch in batches:
            for part in chunks(batch):
                counts, coded, plain = [], [], []
                for text in part.column("text").to_pylist():
                    ids = codec.encode(text or "")
                    counts.append(len(ids))
                    coded.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                    plain.append(hashlib.sha256(codec.decode(ids)).hexdigest())
                yield pa.record_batch({
                    "doc_id": part.column("doc_id"), "n_tokens": pa.array(counts, pa.int64()),
                    "ids_sha256": pa.array(coded, pa.string()), "decoded_sha256": pa.array(plain, pa.string())})

    texts = only(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return texts.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
